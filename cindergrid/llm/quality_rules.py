"""Quality rules: counted rules and the divergence of a document from its language's reference.

Only DataFrame functions. A document is described by counts over its whole text; the reference of
a language sums the character-class and common-word counts of all its documents. The verdict
compares both histograms with the Jensen-Shannon distance (base 2, so 0 to 1).

A document is held against the reference of its language. If that is NULL, or has too few words
behind it, it is held against the ``FALLBACK`` references of the most words, and is only far off if it is far from each.

Defined results: a NULL or empty text has no words and fails the base rule; a document below ``min_words``
is never judged by divergence, one below ``min_words_common`` not by common words; where no
language has enough words, the counted rules decide alone. Repeated rows are judged one by one and get equal results; a
text of any length is one row; an empty table gives no rows. Input columns may have any names but that of the
verdict (``__quality`` in ``judge``), as they travel in one struct beside ours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindergrid.session import work_folder

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Frequent function words of the languages the rules know, all bins of one histogram.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "with", "on", "was", "it"],
    "fr": ["le", "la", "de", "et", "les", "des", "un", "une", "que", "pour", "du", "qui"],
    "de": ["der", "die", "und", "das", "ist", "von", "mit", "ein", "den", "nicht", "zu", "im"],
    "es": ["el", "los", "en", "y", "las", "del", "por", "con", "una", "para", "se", "como"],
}
BINS = sorted({w for words in COMMON_WORDS.values() for w in words})
CLASSES = ["lower", "upper", "digit", "space", "symbol", "punctuation", "beyond_ascii"]

MIN_BASE_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Too few words make a histogram of common words unreliable, so it needs a longer text.
MIN_WORDS = 50
MIN_WORDS_COMMON = 120
MIN_REFERENCE_WORDS = 2000
#: References for documents without one of their own.
FALLBACK = 64
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.27


def words_of(text: Column) -> Column:
    """The words of a text as an array; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


#: Characters of each counted class are made one letter, small letters, blanks and control characters are left out.
_CLASS = {"#": SYMBOLS, "0": "0123456789", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ".": "!\"'()+,-./:;=?@[\\]^_`{}~"}
_FROM = "".join(_CLASS.values()) + "".join(c for c in map(chr, range(128)) if not any(c in known for known in _CLASS.values()))
_TO = "".join(c * len(known) for c, known in _CLASS.items())
#: One letter per common word, so that a document's common words are a short string.
_LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123)]))[: len(BINS)]


def _held(docs: DataFrame) -> DataFrame:
    """The input as one struct column, out of the way of other names."""
    return docs.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("row"))


def _counted(rows: DataFrame, text: str) -> DataFrame:
    """``row`` with the counts of its text: those of the rules, ``chars`` (by class) and ``common`` (by bin, the rest last)."""
    w, t, h = F.col("words"), F.col("text"), F.col("hashes")
    rows = rows.select("row", F.coalesce(F.col("row")[text], F.lit("")).alias("text")).withColumn("words", words_of(t))
    at = lambda x: F.array_position(F.array(*[F.lit(b) for b in BINS]), x)
    hits = F.transform(F.filter(w, lambda x: x.isin(BINS)), lambda x: F.substring(F.lit(_LETTERS), at(x), F.lit(1)))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "row",
        F.size(w).cast("long").alias("n_words"),
        F.length(t).cast("long").alias("length"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.translate(t, _FROM, _TO).alias("classes"),
        F.array_join(hits, "").alias("hits"),
        lines.alias("lines"),
        F.transform(w, lambda x: F.xxhash64(x)).alias("hashes"),
    )
    windows = F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))
    # One lambda for all letters: written out, they make generated methods that are too long for the JVM to compile.
    letters = lambda text, of: F.transform(
        F.array(*[F.lit(c) for c in of]), lambda c: (F.length(text) - F.length(F.replace(F.col(text), c, F.lit("")))).cast("long")
    )
    rows = rows.withColumns({"found": letters("hits", _LETTERS), "counted": letters("classes", _CLASS), "other": F.length("classes").cast("long")})
    symbols, digits, uppers, marks = (F.col("counted")[i] for i in range(len(_CLASS)))
    beyond = F.col("other") - symbols - digits - uppers - marks
    lower = F.col("word_chars") - F.col("other")
    rows = rows.select(
        "row",
        "n_words",
        "word_chars",
        symbols.alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.array(lower, uppers, digits, F.col("length") - F.col("word_chars"), symbols, marks, beyond).alias("chars"),
        F.array_append("found", F.col("n_words") - F.length("hits")).alias("common"),
        F.when(F.size(h) >= 3, windows).alias("windows"),
    )
    # Only a text with a repeated window needs to know where; sorted by hash, equal windows stand together.
    placed = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(F.size("windows") > F.size(F.array_distinct("windows")), placed)).drop("windows")
    p = F.col("placed")
    same = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
    twice = F.transform(F.filter(p, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])
    rows = rows.withColumn("twice", F.sort_array(twice)).drop("placed")
    covered = F.aggregate(
        "twice",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("at")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["at"])).alias("n"), i.alias("at")),
        lambda a: a["n"],
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words")]
    return rows.select("row", *counts, "chars", "common")


def stored_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Every row of ``docs``, of its columns ``keep``, with its counts, as a stored table."""
    path = work_folder(docs.sparkSession, "quality-counts")
    counts = _counted(_held(docs), text)
    counts.withColumn("row", F.struct(*[F.col("row")[c].alias(c) for c in keep])).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def reference(counts: DataFrame, lang: str = "lang") -> DataFrame:
    """One row per language: ``ref_lang``, ``ref_chars`` and ``ref_common``, summed over all its documents."""
    sizes = {"chars": len(CLASSES), "common": len(BINS) + 1}
    sums = [F.sum(F.col(c)[i]).alias(f"{c}{i}") for c, n in sizes.items() for i in range(n)]
    rows = counts.select(F.col("row")[lang].alias("ref_lang"), *sizes).where("ref_lang IS NOT NULL")
    return rows.groupBy("ref_lang").agg(*sums).select(
        "ref_lang", *[F.array(*[F.col(f"{c}{i}") for i in range(n)]).alias(f"ref_{c}") for c, n in sizes.items()]
    )


def _stored(rows: DataFrame) -> DataFrame:
    path = work_folder(rows.sparkSession, "quality-reference")
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def stored_reference(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The reference as a stored table: its size is then known, so Spark broadcasts it only if it is small."""
    return _stored(reference(_counted(_held(docs), text), lang))


def distance(counts: Column, reference_counts: Column) -> Column:
    """Jensen-Shannon distance of two count arrays; NULL if either is NULL or sums to zero."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    part = lambda share, middle: F.when(share > 0, share * F.log2(share / middle)).otherwise(0.0)

    def step(a: Column, x: Column) -> Column:
        # The totals travel in the state; as plain expressions they would be summed anew for every bin.
        p, q = F.try_divide(x["c"], a["n"]), F.try_divide(x["r"], a["m"])
        bits = a["bits"] + part(p, (p + q) / 2) + part(q, (p + q) / 2)
        return F.struct(a["n"].alias("n"), a["m"].alias("m"), bits.alias("bits"))

    start = F.struct(total(counts).alias("n"), total(reference_counts).alias("m"), F.lit(0.0).alias("bits"))
    pairs = F.zip_with(counts, reference_counts, lambda c, r: F.struct(c.alias("c"), r.alias("r")))
    finish = lambda a: F.when((a["n"] > 0) & (a["m"] > 0), F.sqrt(F.greatest(F.lit(0.0), a["bits"] / 2)))
    return F.aggregate(pairs, start, step, finish)


def judge_counts(
    counts: DataFrame,
    references: DataFrame,
    lang: str = "lang",
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    min_words: int = MIN_WORDS,
    min_words_common: int = MIN_WORDS_COMMON,
    min_reference_words: int = MIN_REFERENCE_WORDS,
) -> DataFrame:
    """``row`` and a struct ``verdict``: counts, both distances (to the nearest reference), ``base_failed`` and ``kept``."""
    size = F.aggregate("ref_common", F.lit(0).cast("long"), lambda a, x: a + x)
    able = references.withColumn("ref_words", size).where(F.col("ref_words") >= min_reference_words)
    one = F.struct("ref_chars", "ref_common")
    # A bounded number of references, as one scalar; the rest are joined by language.
    most = able.orderBy(F.col("ref_words").desc(), "ref_lang").limit(FALLBACK)
    others = most.agg(F.collect_list(one).alias("all")).scalar()
    own = able.select("ref_lang", F.array(one).alias("own"))
    rows = counts.join(own, F.col("row")[lang] == F.col("ref_lang"), "left").drop("ref_lang")
    base_failed = (F.col("n_words") < MIN_BASE_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumns({"base_failed": base_failed, "against": F.when(F.col("n_words") >= min_words, F.coalesce(F.col("own"), others))}).drop("own")
    common = F.col("n_words") >= min_words_common
    distances = F.transform(
        "against",
        lambda r: F.struct(
            distance(F.col("chars"), r["ref_chars"]).alias("char_distance"),
            F.when(common, distance(F.col("common"), r["ref_common"])).alias("word_distance"),
        ),
    )
    rows = rows.withColumn("distances", distances).drop("against")
    over = lambda value, most: F.coalesce(value > most, F.lit(False))
    far = lambda d: over(d["char_distance"], max_char_distance) | over(d["word_distance"], max_word_distance)
    off = (F.coalesce(F.size("distances"), F.lit(-1)) > 0) & F.forall("distances", far)
    nearest = lambda name: F.array_min(F.transform("distances", lambda d: d[name]))
    verdict = F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(off, F.lit(False))).alias("kept"),
        nearest("char_distance").alias("char_distance"),
        nearest("word_distance").alias("word_distance"),
    )
    return rows.select("row", verdict.alias("verdict"))


def judge(docs: DataFrame, references: DataFrame, text: str = "text", lang: str = "lang", **limits: float) -> DataFrame:
    """``docs`` with a struct ``__quality``, see :func:`judge_counts`."""
    return judge_counts(_counted(_held(docs), text), references, lang, **limits).select("row.*", F.col("verdict").alias("__quality"))


def judged(docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang") -> DataFrame:
    """``row`` (of the columns ``keep``) and ``verdict`` of every row, against the references of these documents.

    The texts are counted once; the counts are stored without them.
    """
    counts = stored_counts(docs, keep, text)
    return judge_counts(counts, _stored(reference(counts, lang)), lang)


def kept(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, against the references of these documents.

    The rows come out with their texts, so the counts are not stored beside them, which would be a second copy of
    the corpus: the references take a pass of their own, without the windows of words.
    """
    verdicts = judge_counts(_counted(_held(docs), text), stored_reference(docs, text, lang), lang)
    # A generator, unlike a filter, stays above the projections; below them every use of a column
    # would be computed anew.
    once = F.when(F.col("verdict.kept"), F.array(F.lit(True)))
    return verdicts.select("row", F.explode(once).alias("once")).select("row.*")
