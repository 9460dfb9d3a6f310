"""DataFrame operators.  Unless a docstring says otherwise they are lazy."""
