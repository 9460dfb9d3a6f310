"""Personal data by weak supervision, in column expressions only.

Regular expressions propose spans.  Four labelers vote on each or abstain: its
format, a gazetteer, the words before it, and its variety of characters.
Expectation-maximisation over the counts of vote patterns estimates for each kind
how often a labeler that votes is right, about personal data and about other spans,
and how likely each pattern is to be personal data.  A naive Bayes classifier over
votes, length and neighbouring characters, trained on those probabilities, decides
the spans.  Spans of the four base kinds that pass their check stay whatever it says.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.plans.storage import materialize

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "name", "id")

# Fixed values.  A run that could start a match is only tried at its first
# character or where the last match ended, and never given back, so very long runs
# take linear time; the matches are those of the plain patterns:
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card   [0-9]([\x20-]?[0-9])+     (of 12 digits at least)
#   phone  \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
    "name": r"(?<!\p{L})(?:(?:Mr|Mrs|Ms|Dr|Prof)\.? )?\p{Lu}\p{Ll}++ \p{Lu}\p{Ll}++(?!\p{L})",
    "id": r"(?<![0-9A-Za-z-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9A-Za-z-])",
}
# A text without these holds no match.
HINTS = {"email": "@", "ip": ".", "phone": "+"}

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP_PARTS = rf"^{_PART}(?:\.{_PART}){{3}}$"

# Gazetteers and cue words.
DOMAINS = "com|org|net|edu|gov|io|co|info|biz|de|fr|es|uk|eu|us|ch|at|it|nl"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|38|6)"
COUNTRIES = r"^\+(?:1|2[0-9]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
FIRST_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda David Elizabeth William Barbara Thomas "
    "Susan Anna Peter Maria Paul Laura Karl Hans Julia Jean Marie Pierre Sophie Carlos Carmen Juan Ana"
).split()
FAMILY_NAMES = (
    "Smith Johnson Williams Brown Jones Garcia Miller Davis Martinez Lopez Wilson Anderson Taylor Moore "
    "Martin Lee Santos Silva Fernandez Gonzalez Rodriguez Perez Sanchez Mueller Schmidt Schneider Fischer "
    "Weber Meyer Wagner Becker Hoffmann Dubois Durand Moreau Bernard Petit Rossi Russo"
).split()
NO_FAMILY_NAMES = "Street Road Avenue University College Hospital County Island River Lake Park House Company Bank".split()
# Area numbers of no issued identity number.
NO_AREAS = r"^(?:73[4-9]|74[0-9]|77[3-9]|[89][0-9]{2})"
CUES = {
    "email": "e-?mail|contact|correo|courriel|write to",
    "ip": "\\bip\\b|address|host|server|client|login",
    "card": "card|visa|master|amex|credit|tarjeta|carte|karte",
    "phone": "phone|\\btel|call|mobile|fax|m[oó]vil|telefon",
    "secret": "token|secret|passw|api[ _-]?key|\\bkey\\b|auth|credential",
    "name": "name is|named|dear|signed|\\bby\\b|herr|frau|se[nñ]or|madame",
    "id": "ssn|social|security|passport|tax|\\bid\\b",
}
COUNTER_CUES = "version|isbn|order|invoice|sha|md5|commit|uuid|page|figure|e\\.g\\."

VOTES = ("format", "gazetteer", "context", "variety")
FEATURES = (*VOTES, "size", "before", "after")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = digits.substr(F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _passes(kind: str, match: Column) -> Column:
    """The check of a proposed span."""
    n = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(_IP_PARTS)
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    if kind == "name":
        first = F.substring_index(match, " ", 1)
        return first.isin(FIRST_NAMES) | first.rlike("^(?:Mr|Mrs|Ms|Dr|Prof)\\.?$")
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, 1)
    return (vote if no is None else vote.when(no, -1)).otherwise(0)


def _votes(kind: str, match: Column, left: Column) -> list[Column]:
    family = F.substring_index(match, " ", -1)
    sure = F.lit(True)
    form = {
        "email": (match.rlike("^[^.].*@[^-].*[A-Za-z]$"), sure),
        "secret": (match.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$") | match.rlike("[0-9].*[0-9].*[0-9].*[0-9]"), sure),
        "name": (match.rlike("^(?:Mr|Mrs|Ms|Dr|Prof)\\b"), None),
        "id": (match.rlike("^(?!000|666|9)[0-9]{3}([- ])[0-9]{2}\\1"), sure),
    }.get(kind, (sure, None))
    known = {
        "email": (match.rlike(f"(?i)\\.(?:{DOMAINS})$"), sure),
        "ip": (~match.rlike("^(?:0|127|255)\\."), sure),
        "card": (match.rlike(ISSUERS), sure),
        "phone": (match.rlike(COUNTRIES), sure),
        "secret": (match.rlike("^(?:AKIA|ghp_|gho_|sk-|sk_live_|xox[abp]-|AIza)"), None),
        # Proposals rest on titles and first names, so the vote looks at the rest.
        "name": (family.isin(FAMILY_NAMES), family.isin(NO_FAMILY_NAMES)),
        "id": (~match.rlike(NO_AREAS), sure),
    }[kind]
    cue = (left.rlike(CUES[kind]), left.rlike(COUNTER_CUES))
    kinds_of_chars = F.size(F.array_distinct(F.split(F.lower(match), "")))
    return [_vote(*form), _vote(*known), _vote(*cue), _vote(kinds_of_chars >= 5, sure)]


def _neighbour(char: Column) -> Column:
    return F.when(char.isNull() | (char == ""), 0).when(char.rlike("^\\s"), 1).when(char.rlike("^[\\p{L}0-9]"), 2).otherwise(3)


def proposed(text: Column, kind: str) -> Column:
    """Array of (start, end, match) of one kind, in code points, checked."""
    pattern = PATTERNS[kind]
    pairs = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        F.split(text, pattern, -1),  # what lies before, between and behind the matches
        lambda match, gap: F.struct(match.alias("match"), gap.alias("gap")),
    )
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def step(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        end = start + F.coalesce(F.length(pair["match"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"))
        return F.struct(
            end.alias("at"),
            F.when(pair["match"].isNotNull(), F.concat(done["spans"], F.array(span)))
            .otherwise(done["spans"])
            .alias("spans"),
        )

    placed = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda done: done["spans"])
    spans = F.filter(placed, lambda s: _passes(kind, s["match"]))
    hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else F.regexp_like(text, F.lit(pattern))
    return F.when(hint, spans).otherwise(none)


def candidates(text_col: str = "text") -> Column:
    """Array of proposed spans with votes and features; empty for a null text."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def described(kind: str) -> Column:
        def describe(s: Column) -> Column:
            start, end = s["start"], s["end"]
            from_ = F.greatest(F.lit(0), start - 32)
            left = F.lower(text.substr(from_ + 1, start - from_))
            size = F.least(F.lit(9), F.floor((end - start) / 8).cast("int"))
            before = F.when(start > 0, text.substr(start, F.lit(1)))
            cells = [*_votes(kind, s["match"], left), size, _neighbour(before), _neighbour(text.substr(end + 1, F.lit(1)))]
            named = [c.cast("int").alias(n) for c, n in zip(cells, FEATURES, strict=True)]
            return F.struct(start, F.lit(KINDS.index(kind)).alias("kind"), end, *named)

        return F.transform(proposed(text, kind), describe)

    return F.array_sort(F.concat(*map(described, KINDS)))


@dataclass(frozen=True)
class SpanModel:
    """Log odds per (kind, value) of every feature.

    ``reliability`` holds, by (kind, labeler) that has voted, how often its vote is
    right about personal data and about other spans.
    """

    weights: dict[str, dict[tuple[int, int], float]]
    reliability: dict[tuple[str, str], tuple[float, float]]

    def accepts(self, span: Column, least: float = 0.5) -> Column:
        """Whether the classifier, or the base rule, takes the span."""
        odds = F.lit(0.0)
        for name in FEATURES:
            cells = [F.lit(x) for key, v in sorted(self.weights.get(name, {}).items()) for x in (_flat(*key), v)]
            if cells:
                found = F.element_at(F.create_map(*cells), _flat(span["kind"], span[name]))
                odds = odds + F.coalesce(found, F.lit(0.0))
        return (span["kind"] < len(BASE)) | (odds >= math.log(least / (1 - least)))


def _flat(kind, value):
    return kind * 32 + value + 1


#: What is believed of a labeler before it has voted: so many votes, right and wrong.
PRIOR_VOTES = (6.0, 2.0)
#: Candidates' worth of belief that a feature tells nothing.
PRIOR_SPANS = 4.0


def estimated(counts: list[tuple], rounds: int = 50) -> tuple[dict, list[float]]:
    """(votes right about personal data and about others by (kind, labeler), chance of each row).

    ``counts`` has rows (kind, feature values, number), votes first.  Abstentions
    tell nothing.  Candidates have no labels, so both outcomes start with even odds
    and no labeler is ever quite sure.
    """
    right, wrong = PRIOR_VOTES
    start = right / (right + wrong)
    kinds = {kind for kind, _, _ in counts}
    rates = {(kind, j): (start, start) for kind in kinds for j in range(len(VOTES))}

    def chance(kind: int, cells: tuple[int, ...]) -> float:
        odds = 0.0
        for j in range(len(VOTES)):
            yes, no = rates[kind, j]
            if cells[j]:
                odds += math.log(yes / (1 - no)) if cells[j] > 0 else math.log((1 - yes) / no)
        return 1 / (1 + math.exp(-odds))

    for _ in range(rounds):
        chances = [chance(kind, cells) for kind, cells, _ in counts]
        seen = {key: [right, right + wrong, right, right + wrong] for key in rates}
        for (kind, cells, n), p in zip(counts, chances, strict=True):
            for j in range(len(VOTES)):
                if cells[j]:
                    cell = seen[kind, j]
                    cell[0] += n * p * (cells[j] > 0)
                    cell[1] += n * p
                    cell[2] += n * (1 - p) * (cells[j] < 0)
                    cell[3] += n * (1 - p)
        rates = {key: (a / b, c / d) for key, (a, b, c, d) in seen.items()}
    return rates, [chance(kind, cells) for kind, cells, _ in counts]


def classifier(counts: list[tuple], rates: dict, chances: list[float]) -> SpanModel:
    """Naive Bayes from the chances of the counted feature rows.

    Each class is drawn towards the share a value has among all candidates of its
    kind, so that a value neither class has seen much of tells little.
    """
    weights: dict[str, dict[tuple[int, int], float]] = {name: {} for name in FEATURES}
    for (kind, j), (yes, no) in rates.items():
        weights[VOTES[j]][kind, 1] = math.log(yes / (1 - no))
        weights[VOTES[j]][kind, -1] = math.log((1 - yes) / no)
    mass: dict[int, list[float]] = {}
    for (kind, _, n), p in zip(counts, chances, strict=True):
        both = mass.setdefault(kind, [0.0, 0.0])
        both[0] += n * p
        both[1] += n * (1 - p)
    for j in range(len(VOTES), len(FEATURES)):
        held: dict[tuple[int, int], list[float]] = {}
        for (kind, cells, n), p in zip(counts, chances, strict=True):
            cell = held.setdefault((kind, cells[j]), [0.0, 0.0])
            cell[0] += n * p
            cell[1] += n * (1 - p)
        for (kind, value), cell in held.items():
            share = sum(cell) / sum(mass[kind])
            yes, no = ((x + PRIOR_SPANS * share) / (m + PRIOR_SPANS) for x, m in zip(cell, mass[kind], strict=True))
            weights[FEATURES[j]][kind, value] = math.log(yes / no)
    voted = {(kind, j) for kind, cells, _ in counts for j in range(len(VOTES)) if cells[j]}
    return SpanModel(weights, {(KINDS[k], VOTES[j]): r for (k, j), r in rates.items() if (k, j) in voted})


def fit_spans(found: DataFrame, col: str = "found", rounds: int = 50) -> SpanModel:
    """Train on the candidates of all rows.

    Only the counts of distinct feature rows reach the driver: kinds, three values
    per vote, ten sizes and four neighbours on each side bound their number.
    """
    rows = found.select(F.explode(col).alias("s")).groupBy(F.col("s.kind"), *(f"s.{n}" for n in FEATURES))
    counts = [(r["kind"], tuple(r[n] for n in FEATURES), r["n"]) for r in rows.agg(F.count("*").alias("n")).collect()]
    counts.sort()
    return classifier(counts, *estimated(counts, rounds))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    text = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, text), ",")


def personal_data(found: DataFrame, model: SpanModel) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans from ``found(doc_id, found)``."""
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    spans = F.filter("found", lambda s: model.accepts(s))
    number = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *(number(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        F.size(spans).cast("bigint").alias("n_spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by its first kind."""
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))

    def step(done: Column, s: Column) -> Column:
        label = F.element_at(names, s["kind"] + 1)
        gap = text.substr(done["at"] + 1, s["start"] - done["at"])
        out = F.when(s["start"] >= done["at"], F.concat(done["out"], gap, label)).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda done: F.concat(done["out"], text.substr(done["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, rest)).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents, all rows and columns, with personal data replaced by its kind.

    Null and empty texts stay as they are.  ``length_col``, if there, follows.  The
    candidates are found once and written with their rows.
    """
    mark = "__found"
    while mark in docs.columns:
        mark += "_"
    found = materialize(docs.withColumn(mark, candidates(text_col)), "candidates")
    model = fit_spans(found.select(mark), mark)
    text = F.col(text_col)
    out = found.withColumn(mark, F.filter(mark, lambda s: model.accepts(s))).withColumn(text_col, redacted(text, F.col(mark)))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        length = F.length(text_col).cast(kind)
        out = out.withColumn(length_col, F.when(F.size(mark) > 0, length).otherwise(F.col(length_col)))
    return out.select(*docs.columns)
