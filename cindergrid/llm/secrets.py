"""Secret scans: three base patterns, and sliding-window Shannon entropy over candidate strings.

Only DataFrame functions. A candidate is a run of at least ``WINDOW`` letters, digits and ``+/_=-``. A
window of ``WINDOW`` characters slides over it; counts per character are kept, one going out and one
coming in, and with them the sum of c * log2 c, so each step costs the same whatever the window. The
highest entropy is held against the threshold of the candidate's character class. Allow-listed
candidates (identifiers, paths, sequences, digests named as such, placeholders) are suppressed, as are
those that touch a base span.

Defined results: a NULL or empty text has no spans; a candidate of one class without a threshold (digits
alone) is never reported; repeated rows get equal results; a text of any length is one row; an empty table
gives no rows. Input columns may have any names but ``__base`` and ``__spans``, and those that end in ``__m``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindergrid.llm.spans import of_kind, overlaps, with_spans

_KEYWORDS = r"(?i:password|passwd|secret|token|api_?key)"
ASSIGN = _KEYWORDS + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
_ASSIGNED = "^" + _KEYWORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
#: With the least length in the pattern; runs are maximal, so this drops what is too short and no more.
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+" % WINDOW

#: Least bits per character in some window, by character class: the first class whose pattern fits. Random strings of
#: ``WINDOW`` characters reach them with a probability of 0.95 to 0.98, longer ones with more; what tells words
#: from random letters is the allow-list, not a threshold near the most that a window can have.
CLASSES = [
    ("digits", r"^[0-9_=-]+$", None),
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("letters", r"^[a-z_=-]+$|^[A-Z_=-]+$", 3.3),
    ("letters of both cases", r"^[A-Za-z_=-]+$", 3.6),
    ("alphanumeric", r"^[a-z0-9]+$|^[A-Z0-9]+$", 3.5),
    ("alphanumeric of both cases", r"^[A-Za-z0-9]+$", 3.65),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.65),
]
#: Words put together: no four consonants in a row, and digits in two groups at most.
_WORDS = r"(?i)^(?!.*[bcdfghjklmnpqrstvwxz]{4})[a-z_=-]+[0-9]{0,4}[a-z_=-]*[0-9]{0,4}$"
#: Suppressed candidates.
ALLOWED = [
    r"(?i)example|sample|placeholder|changeme|xxxx|dummy",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)abcdefgh|01234567|12345678|qwertyui",
    r"^(?:[A-Za-z]+[/_=-]+)+[A-Za-z]*$",
    r"(.)\1{5}",
    _WORDS,
]
#: Suppressed if this ends just before the candidate.
ALLOWED_BEFORE = r"(?i)(?:sha1|sha256|sha512|md5|commit|digest|checksum)[\"']?\x20*[:=-]?\x20*[\"']?$"
BASE = ["assign", "access", "hex"]


def window_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy of a window, in bits per character, by incremental counts."""

    def weight(c: Column) -> Column:
        return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(0.0)

    codes = F.transform(F.split(candidate, ""), lambda c: F.ascii(c))
    codes = F.filter(codes, lambda c: c > 0)

    def step(seen: Column, i: Column) -> Column:
        coming = F.get(codes_of(seen), i)
        going = F.when(i >= window, F.get(codes_of(seen), i - window)).otherwise(F.lit(-1))
        same = coming == going
        n_in, n_out = F.get(seen["counts"], coming), F.get(seen["counts"], going)
        gain = weight(n_in + 1) - weight(n_in)
        loss = F.when(going >= 0, weight(n_out) - weight(n_out - 1)).otherwise(0.0)
        total = F.when(same, seen["total"]).otherwise(seen["total"] + gain - loss)
        counts = F.when(same, seen["counts"]).otherwise(
            F.transform(seen["counts"], lambda c, k: c + (k == coming).cast("int") - (k == going).cast("int"))
        )
        bits = F.when(i >= window - 1, F.lit(math.log2(window)) - total / window).otherwise(0.0)
        return F.struct(codes_of(seen).alias("codes"), counts.alias("counts"), total.alias("total"), F.greatest(seen["best"], bits).alias("best"))

    def codes_of(seen: Column) -> Column:
        return seen["codes"]

    start = F.struct(codes.alias("codes"), F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
    return F.aggregate(F.sequence(F.lit(0), F.length(candidate) - 1), start, step, lambda s: s["best"])


def threshold(candidate: Column) -> Column:
    out = None
    for _, pattern, least in CLASSES:
        value = F.lit(least).cast("double")
        fits = candidate.rlike(pattern)
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__base`` and ``__spans``: (start, rank, kind, end), sorted by start, then kind."""
    found = with_spans(docs, text, {"__assign": ASSIGN, "__access": ACCESS, "__hex": HEX, "__candidates": CANDIDATE})
    found = found.withColumn("__assign", F.filter("__assign", lambda s: F.length(F.regexp_extract(s["match"], _ASSIGNED, 1)) >= 8))
    base = F.concat(*[of_kind(F.col(f"__{k}"), k, i) for i, k in enumerate(BASE)])
    by_start = lambda spans: F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    found = found.withColumn("__base", by_start(base))

    def suspicious(s: Column) -> Column:
        allowed = F.lit(False)
        for pattern in ALLOWED:
            allowed = allowed | s["match"].rlike(pattern)
        before = F.substring(F.col(text), F.greatest(F.lit(1), s["start"] - 29), F.least(F.lit(30), s["start"]))
        limit = threshold(s["match"])
        return (
            limit.isNotNull()
            & ~allowed
            & ~before.rlike(ALLOWED_BEFORE)
            & ~overlaps(s, F.col("__base"))
            & (window_entropy(s["match"]) >= limit)
        )

    kept = F.when(F.size("__candidates") > 0, of_kind(F.filter("__candidates", suspicious), "entropy", len(BASE)))
    found = found.withColumn("__spans", F.when(F.size(kept) > 0, by_start(F.concat("__base", by_start(kept)))).otherwise(F.col("__base")))
    return found.drop("__assign", "__access", "__hex", "__candidates")
