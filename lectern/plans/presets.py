"""Parameter sets of the runs."""

from __future__ import annotations

from dataclasses import dataclass

from lectern.functions import text as tx
from lectern.operators.features import FeatureSpec
from lectern.operators.models import ModelSpec


@dataclass(frozen=True)
class Preset:
    """Everything a run needs besides its input; use ``dataclasses.replace`` to
    override a value.

    ``sample_fraction`` and ``sample_rows`` bound the rows that models are fitted
    on; every test row is evaluated whatever they are.
    """

    features: FeatureSpec
    models: tuple[ModelSpec, ...]
    sample_fraction: float | None = None
    sample_rows: int | None = None
    clean: bool = True
    min_text_length: int = 30
    seed: int = 42


def _linear(vocab_size: int, min_df: float, **iterations: int) -> dict:
    return {
        "features": FeatureSpec(vocab_size=vocab_size, min_df=min_df),
        "models": tuple(
            ModelSpec(
                name,
                {"maxIter": n, "regParam": 0.1}
                | ({"elasticNetParam": 0.0} if name == "logreg" else {}),
            )
            for name, n in iterations.items()
        ),
    }


def _trees(vocab_size: int, min_df: float, forest: tuple[int, int], boosted: tuple[int, int]) -> dict:
    return {
        "features": FeatureSpec(vocab_size=vocab_size, min_df=min_df),
        "models": (
            ModelSpec(
                "randomforest",
                {"numTrees": forest[0], "maxDepth": forest[1], "seed": 42, "featureSubsetStrategy": "auto"},
            ),
            ModelSpec("gbt", {"maxIter": boosted[0], "maxDepth": boosted[1], "seed": 42}),
        ),
    }


# Sample, vocabulary and model sizes per run and mode.
LINEAR = {
    "debug": Preset(**_linear(12000, 5, linearsvc=20), sample_fraction=0.10),
    "full": Preset(**_linear(20000, 10, logreg=30, linearsvc=30)),
}
TREES = {
    "debug": Preset(**_trees(12000, 5, (60, 10), (35, 6)), sample_fraction=0.10),
    "demo": Preset(**_trees(12000, 5, (50, 9), (35, 6)), sample_fraction=0.20),
    "full": Preset(**_trees(20000, 10, (120, 12), (60, 7))),
}
_COMPARISON = Preset(
    features=FeatureSpec(pattern=tx.NON_WORD, vocab_size=20000, min_df=2, binary_tf=False),
    models=(
        ModelSpec("logreg", {"maxIter": 50, "regParam": 0.0}),
        ModelSpec("linearsvc", {"maxIter": 50, "regParam": 0.0}),
        ModelSpec("randomforest", {"numTrees": 50, "maxDepth": 10}),
        ModelSpec("gbt", {"maxIter": 30, "maxDepth": 5}),
    ),
    clean=False,
)
COMPARISON = {
    "debug": Preset(**{**_COMPARISON.__dict__, "sample_rows": 5000}),
    "full": _COMPARISON,
}
HASHED_MODELS = {
    "logreg": ModelSpec("logreg", {"maxIter": 30, "regParam": 0.0}),
    "linearsvc": ModelSpec("linearsvc", {"maxIter": 30, "regParam": 0.0}),
    "randomforest": ModelSpec("randomforest", {"numTrees": 10, "maxDepth": 6}),
    "gbt": ModelSpec("gbt", {"maxIter": 10, "maxDepth": 4}),
}
HASHED_FEATURES = FeatureSpec(pattern=tx.NON_WORD, binary_tf=False, use_idf=False)
HASHED_NUM_FEATURES = 65536
