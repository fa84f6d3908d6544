"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Only DataFrame functions over the texts. Candidates are the base matches and looser ones. Three
labelers vote +1, 0 (abstain) or -1 on each: a shape rule (regex), gazetteers, and the words around the
candidate. Votes and a few span features make a code; the corpus is reduced to counts per code, of
which there are at most ``CODES``, whatever its size. Expectation-maximisation over these counts
estimates how reliable each labeler is for each kind, starting from the most trusted one, and how likely each
code is personal data; a logistic span classifier is trained on those likelihoods and applied to every candidate as one expression.

Base matches always stay; a looser candidate is added if the classifier accepts it and it touches no
base span. Defined results: a NULL or empty text has no spans; without candidates nothing is learned
or added; repeated rows count as often as they occur and get equal results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindergrid.llm.spans import of_kind, overlaps, with_spans
from cindergrid.session import work_folder

KINDS = ["email", "ip", "card", "phone", "ssn", "name"]
BASE = KINDS[:4]

#: A local part begins where no character of its class stands before, or where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Looser candidates, in one pass: local phone, social security number, spelled-out address, titled name.
LOOSE = (
    r"(?<![0-9+-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"
    r"|(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
    r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:[\[(](?:dot|DOT)[\])]|\.)\x20?[A-Za-z0-9-]{1,63}+){1,8}+"
    r"|(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra?)\.?\x20[A-Z][a-z]{1,30}+(?:\x20[A-Z][a-z]{1,30}+)?"
)

# Small gazetteers and cue words.
GIVEN_NAMES = "Anna James John Maria Mary Michael Peter Sarah Thomas Laura David Julia Paul Marie Jean Hans Karl Juan Carlos Carmen".split()
DOMAINS = "com org net edu gov io de fr es uk eu info".split()
CUES = r"(?i)\b(?:call|phone|tel|fax|mobile|cell|mail|e-mail|email|contact|write to|reach|ssn|social security|card|visa|address|name is|signed|dear)\b[^.\n]{0,20}$"
AGAINST = r"(?i)\b(?:order|invoice|version|ver|serial|part|isbn|issn|section|page|no|item|figure|table|chapter)\b[.:#\x20]{0,4}$"
CONTEXT = 40

LABELERS = 3
FEATURES = 2
CODES = len(KINDS) * 3**LABELERS * 2**FEATURES
EM_ROUNDS = 500
#: Pseudo-votes by which a kind's tables lean on those of all kinds.
POOLED = 20.0
FIT_ROUNDS = 200


def _below_256(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``__email, __ip, __card, __phone`` (checked) and ``__loose`` (candidates): (start, end, match)."""
    found = with_spans(docs, text, {"__email": EMAIL, "__ip": IP, "__card": CARD, "__phone": PHONE, "__loose": LOOSE})
    digits = lambda s: F.regexp_replace(s["match"], "[^0-9]", "")
    return found.withColumns(
        {
            "__ip": F.filter("__ip", lambda s: F.forall(F.split(s["match"], r"\."), _below_256)),
            "__card": F.filter(
                "__card",
                lambda s: F.when(F.length(digits(s)).between(13, 19), F.call_function("luhn_check", digits(s))).otherwise(F.lit(False)),
            ),
            "__phone": F.filter("__phone", lambda s: F.length(digits(s)).between(9, 15)),
        }
    )


def _kind(match: Column) -> Column:
    """The kind of a looser candidate, by rank."""
    return (
        F.when(match.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), KINDS.index("ssn"))
        .when(match.rlike(r"[\[(](?:at|AT)[\])]"), KINDS.index("email"))
        .when(match.rlike(r"^[A-Z]"), KINDS.index("name"))
        .otherwise(KINDS.index("phone"))
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(rank: Column, s: Column, text: Column) -> list[Column]:
    match = s["match"]
    email, ip, card, phone, ssn, name = (rank == i for i in range(len(KINDS)))
    shape = _vote(
        (email & match.rlike(r"[A-Za-z]{2,}$"))
        | (ip & ~match.rlike(r"^(?:0|127|255)\."))
        | (card & match.rlike(r"^[3-6]"))
        | (phone & match.rlike(r"^\+|^\(?[2-9][0-9]{2}\)?[\x20.-]{1,2}[2-9]"))
        | (ssn & ~match.rlike(r"^(?:000|666|9)|-00-|-0000$"))
        | (name & match.rlike(r"\x20[A-Z][a-z]+\x20[A-Z]")),
        email | ip | card | phone | ssn,
    )
    gazetteer = _vote(
        (email & F.lower(F.regexp_extract(match, r"([A-Za-z]+)$", 1)).isin(DOMAINS))
        | (name & F.regexp_extract(match, r"\x20([A-Z][a-z]+)", 1).isin(GIVEN_NAMES))
        | ((phone | ssn | card) & ~match.rlike("555|123-?45|0000")),
        (phone | ssn) & match.rlike("123-?45|0000"),
    )
    before = F.substring(text, F.greatest(F.lit(1), s["start"] - CONTEXT + 1), F.least(F.lit(CONTEXT), s["start"]))
    context = _vote(before.rlike(CUES), before.rlike(AGAINST))
    return [shape, gazetteer, context]


def _code(rank: Column, s: Column, text: Column) -> Column:
    """Kind, votes and features of a candidate as one number below ``CODES``."""
    code = rank
    for vote in _votes(rank, s, text):
        code = code * 3 + (vote + 1)
    after = F.substring(text, s["end"] + 1, 1)
    for feature in (after.rlike(r"^[\x20.,;:!?)\n]?$"), F.length(s["match"]) >= 12):
        code = code * 2 + feature.cast("int")
    return code.cast("int")


def _decode(code: int) -> tuple[int, list[int], list[int]]:
    features, votes = [], []
    for _ in range(FEATURES):
        code, f = divmod(code, 2)
        features.insert(0, f)
    for _ in range(LABELERS):
        code, v = divmod(code, 3)
        votes.insert(0, v - 1)
    return code, votes, features


def _start(votes: list[int]) -> float:
    """Where EM starts: the word of the most trusted labeler that does not abstain (they are listed by trust)."""
    said = next((v for v in votes if v), 0)
    return {1: 0.95, 0: 0.5, -1: 0.05}[said]


def reliabilities(counts: dict[int, int], rounds: int = EM_ROUNDS) -> tuple[dict[int, float], list[dict]]:
    """EM for two classes: P(personal) per code, and per labeler the chances of its votes in each class.

    Each kind has its own prior and tables, drawn towards those of all kinds by ``POOLED`` pseudo-votes, so a
    rare kind leans on the others and a common one speaks for itself. Votes alone fix the tables only with three
    labelers that know something; with fewer, the start decides, and it trusts the first labeler most.
    The tables returned are those of all kinds.
    """
    rows = {c: (*_decode(c)[:2], n) for c, n in counts.items()}
    chance = {c: _start(votes) for c, (_, votes, _) in rows.items()}
    kinds = sorted({kind for kind, _, _ in rows.values()})

    def tables_of(kind: int | None, lean: list[dict] | None) -> tuple[float, list[dict]]:
        mine = {c: (votes, n) for c, (k, votes, n) in rows.items() if kind is None or k == kind}
        total = sum(n for _, n in mine.values())
        prior = (sum(chance[c] * n for c, (_, n) in mine.items()) + 1) / (total + 2)
        tables = []
        for k in range(LABELERS):
            table = {}
            for positive in (True, False):
                mass = {v: POOLED * lean[k][positive][v] if lean else 1.0 for v in (-1, 0, 1)}
                for c, (votes, n) in mine.items():
                    mass[votes[k]] += n * (chance[c] if positive else 1 - chance[c])
                whole = sum(mass.values())
                table[positive] = {v: m / whole for v, m in mass.items()}
            tables.append(table)
        return prior, tables

    pooled: list[dict] = []
    for _ in range(rounds):
        _, pooled = tables_of(None, None)
        of_kind_ = {kind: tables_of(kind, pooled) for kind in kinds}
        for c, (kind, votes, _) in rows.items():
            prior, tables = of_kind_[kind]
            odds = math.log(prior / (1 - prior)) + sum(
                math.log(tables[k][True][v] / tables[k][False][v]) for k, v in enumerate(votes)
            )
            chance[c] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return chance, pooled


def _inputs(code: int) -> list[float]:
    kind, votes, features = _decode(code)
    return [1.0, *[float(v) for v in votes], *[float(f) for f in features], *[float(kind == k) for k in range(len(KINDS))]]


def train(counts: dict[int, int], rounds: int = FIT_ROUNDS) -> list[float] | None:
    """Weights of the logistic span classifier, fitted to the EM likelihoods weighted by count."""
    if not counts:
        return None
    chance, _ = reliabilities(counts)
    rows = [(_inputs(c), chance[c], math.log1p(n)) for c, n in sorted(counts.items())]
    whole = sum(w for _, _, w in rows)
    weights = [0.0] * len(rows[0][0])
    for _ in range(rounds):
        slope = [0.002 * w for w in weights]
        for x, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(weights, x, strict=True))))))
            for i, v in enumerate(x):
                slope[i] += n / whole * (p - y) * v
        weights = [w - 1.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def accepted(weights: list[float] | None) -> list[int]:
    """The codes that the classifier takes for personal data."""
    if weights is None:
        return []
    return [c for c in range(CODES) if sum(a * b for a, b in zip(weights, _inputs(c), strict=True)) > 0]


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``base`` and ``spans``: (rank, start, end, kind) sorted by kind, then start."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    found = base_spans(rows, "__text")

    def coded(spans: Column, rank: int) -> Column:
        return F.transform(spans, lambda s: _code(F.lit(rank), s, F.col("__text")))

    base = F.array_sort(F.concat(*[of_kind(F.col(f"__{k}"), k, i) for i, k in enumerate(BASE)]))
    found = found.withColumn("base", base)
    loose = F.filter("__loose", lambda s: ~overlaps(s, F.col("base")))
    ranked = F.transform(
        loose,
        lambda s: F.struct(
            _kind(s["match"]).alias("rank"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.element_at(F.array(*[F.lit(k) for k in KINDS]), _kind(s["match"]) + 1).alias("kind"),
            _code(_kind(s["match"]), s, F.col("__text")).alias("code"),
        ),
    )
    found = found.withColumn("loose", F.when(F.size("__loose") > 0, ranked))
    codes = F.concat(*[coded(F.col(f"__{k}"), i) for i, k in enumerate(BASE)])
    # Spans and codes are small; storing them saves a second pass over the texts.
    path = work_folder(docs.sparkSession, "pii-candidates")
    found.select("doc_id", "base", "loose", codes.alias("codes")).write.parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    each = stored.select(F.explode(F.concat("codes", F.coalesce(F.transform("loose", lambda s: s["code"]), F.array().cast("array<int>")))).alias("code"))
    counts = {r["code"]: r["n"] for r in each.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    good = accepted(train(counts))
    added = F.transform(
        F.filter("loose", lambda s: s["code"].isin(good) if good else F.lit(False)),
        lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    spans = F.when(F.col("loose").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", added)))
    return stored.select("doc_id", "base", spans.alias("spans"))
