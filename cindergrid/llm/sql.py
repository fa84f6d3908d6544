"""DuckDB SQL for the queries that SQL can express; written apart from the operators."""

from __future__ import annotations

_SIZED = r"""
sized AS (
  SELECT doc_id, source,
    CASE WHEN text IS NULL THEN 0 ELSE len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) END::BIGINT AS size
  FROM documents)"""


def _lot(*parts: str) -> str:
    joined = " || ':' || ".join(["'mix-1'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return f"CAST('0x' || substr(md5({joined}), 1, 8) AS BIGINT)"


OP9 = f"""
WITH {_SIZED},
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
named AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS source_id FROM per),
weighed AS (
  SELECT *, CASE (source_id - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS weight, 3 * source_size AS cap,
    (SELECT sum(source_size)::BIGINT FROM per) AS total
  FROM named),
lefts AS (
  SELECT *, total - coalesce((SELECT sum(b.cap)::BIGINT FROM weighed b WHERE (b.cap / b.weight, b.source_id) < (a.cap / a.weight, a.source_id)), 0) AS left_tokens,
    (SELECT sum(b.weight)::BIGINT FROM weighed b WHERE (b.cap / b.weight, b.source_id) >= (a.cap / a.weight, a.source_id)) AS left_weight
  FROM weighed a),
unit AS (
  SELECT left_tokens AS ut, left_weight AS uw FROM lefts WHERE cap * left_weight >= left_tokens * weight
  ORDER BY cap / weight, source_id LIMIT 1),
targets AS (
  SELECT source_id, source, source_size, total,
    CASE WHEN cap * uw <= ut * weight THEN cap::DOUBLE ELSE (ut * weight)::DOUBLE / uw::DOUBLE END AS target,
    greatest(1, ceil(total / 65536))::BIGINT AS block
  FROM lefts CROSS JOIN unit),
seated AS (SELECT *, round(total / block)::BIGINT AS seats FROM targets),
entered AS (
  SELECT source_id, seats, target / (2 * k - 1) AS quotient, k
  FROM seated, unnest(range(1, (floor(target / block) + 3)::BIGINT)) AS u(k) WHERE target > 0),
won AS (SELECT source_id FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, source_id, k) AS place FROM entered) WHERE place <= seats),
quotas AS (SELECT source_id, count(*) AS source_quota FROM won GROUP BY source_id),
sources AS (
  SELECT s.*, q.source_quota, greatest(1, floor(source_size / (32 * block)))::BIGINT AS n_shards
  FROM seated s LEFT JOIN quotas q USING (source_id)),
sharded AS (
  SELECT d.doc_id, d.size, s.source_id, s.source_size, s.target, s.block, s.source_quota,
    {_lot("'shard'", "d.doc_id")} % s.n_shards AS shard
  FROM sized d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source),
placed AS (
  SELECT *, row_number() OVER w AS place, (sum(size) OVER (w ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sharded WINDOW w AS (PARTITION BY source_id, shard ORDER BY {_lot("'order'", "doc_id")}, doc_id, size)),
shards AS (
  SELECT source_id, shard, block, source_size, source_quota, sum(size)::BIGINT AS shard_size, ceil(sum(size) / block)::BIGINT AS n_blocks
  FROM placed GROUP BY source_id, shard, block, source_size, source_quota HAVING sum(size) > 0),
shard_entered AS (
  SELECT *, shard_size / (2 * k - 1) AS quotient
  FROM shards, unnest(range(1, (floor(source_quota * shard_size / source_size) + 3)::BIGINT)) AS u(k)),
shard_won AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY quotient DESC, source_id, shard, k) AS p FROM shard_entered)
  WHERE p <= source_quota),
drawn AS (
  SELECT source_id, shard, block, n_blocks, least(count(*), 3 * n_blocks) // n_blocks AS passes, least(count(*), 3 * n_blocks) % n_blocks AS extra
  FROM shard_won GROUP BY source_id, shard, block, n_blocks),
chosen AS (
  SELECT source_id, shard, b FROM (
    SELECT *, row_number() OVER (PARTITION BY source_id, shard ORDER BY {_lot("'block'", "source_id", "shard", "b")}, b) AS r
    FROM drawn, unnest(range(0, n_blocks)) AS u(b))
  WHERE r <= extra),
pieces AS (
  SELECT p.source_id, p.shard, p.place, least(start + size, (u.b + 1) * block) - greatest(start, u.b * block) AS overlap, u.b
  FROM placed p, unnest(range(start // block, (start + size - 1) // block + 1)) AS u(b) WHERE size > 0),
partly AS (SELECT source_id, shard, place, sum(overlap)::BIGINT AS partly FROM pieces JOIN chosen USING (source_id, shard, b) GROUP BY source_id, shard, place)
SELECT doc_id, size, source_size, target, (coalesce(passes, 0) * size + coalesce(partly, 0))::BIGINT AS taken
FROM placed LEFT JOIN (SELECT source_id, shard, passes FROM drawn) USING (source_id, shard) LEFT JOIN partly USING (source_id, shard, place)
"""


def _distance(counts: str, reference: str, bins: int) -> str:
    p, q = f"({counts}[i] / list_sum({counts}))", f"({reference}[i] / list_sum({reference}))"
    part = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {q}) / 2)) ELSE 0 END"
    return f"sqrt(greatest(0, list_sum(list_transform(range(1, {bins + 1}), lambda i: {part(p)} + {part(q)})) / 2))"


# The common words that the rules count.
_COMMON = (
    "the of and to in is that for with on was it le la de et les des un une que pour du qui "
    "der die und das ist von mit ein den nicht zu im el los en y las del por con una para se como"
).split()

OP10 = rf"""
WITH split AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
counted AS (
  SELECT *, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS digits,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS uppers,
    length(text) - length(regexp_replace(text, '[!-/:-@\[-`{{-~]', '', 'g')) AS marks,
    length(text) - length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) AS beyond,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    list_transform({_COMMON!r}, lambda b: len(list_filter(words, lambda w: w = b))) AS found
  FROM split),
hist AS (
  SELECT *, length(text) - word_chars AS blanks,
    [word_chars - uppers - digits - marks - beyond, uppers, digits, length(text) - word_chars, n_symbols, marks - n_symbols, beyond] AS chars,
    list_append(found, n_words - list_sum(found)) AS common
  FROM counted),
ref_chars AS (
  SELECT lang, list(n ORDER BY i) AS ref_chars
  FROM (SELECT lang, i, sum(chars[i]) AS n FROM hist, range(1, 8) AS u(i) GROUP BY lang, i) GROUP BY lang),
ref_common AS (
  SELECT lang, list(n ORDER BY i) AS ref_common
  FROM (SELECT lang, i, sum(common[i]) AS n FROM hist, range(1, {len(_COMMON) + 2}) AS u(i) GROUP BY lang, i) GROUP BY lang),
windows AS (SELECT doc_id, i, words[i:i + 2] AS w FROM hist, range(1, greatest(n_words - 1, 1)) AS u(i)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS c FROM windows) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM twice, range(0, 3) AS u(j) GROUP BY doc_id),
based AS (
  SELECT doc_id, lang, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, chars, common,
    n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
  FROM hist LEFT JOIN covered USING (doc_id)),
refs AS (
  SELECT lang, ref_chars, ref_common, list_sum(ref_common) AS n FROM ref_chars JOIN ref_common USING (lang)
  WHERE lang IS NOT NULL AND list_sum(ref_common) >= 2000),
fallback AS (SELECT * FROM refs ORDER BY n DESC, lang LIMIT 64),
against AS (
  SELECT b.doc_id, b.n_words, chars, common, ref_chars, ref_common FROM based b JOIN refs USING (lang) WHERE n_words >= 50
  UNION ALL
  SELECT b.doc_id, b.n_words, chars, common, ref_chars, ref_common FROM based b, fallback
  WHERE n_words >= 50 AND (b.lang IS NULL OR b.lang NOT IN (SELECT lang FROM refs))),
held AS (
  SELECT doc_id, n_words, {_distance("chars", "ref_chars", 7)} AS dc, {_distance("common", "ref_common", len(_COMMON) + 1)} AS dw
  FROM against),
far AS (SELECT doc_id, bool_and(dc > 0.30 OR n_words >= 120 AND dw > 0.27) AS off FROM held GROUP BY doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(off, false) AS kept
FROM based LEFT JOIN far USING (doc_id)
"""

_WORDS7 = r"""CASE WHEN text IS NULL THEN [] ELSE list_filter(
  string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
  lambda x: x <> '') END"""

OP7 = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS7} AS words FROM benchmark),
window_ AS (
  SELECT DISTINCT item, words[i:i + 9] AS w, least(len(words), 10) AS n
  FROM item, range(1, greatest(len(words) - 8, 2)) AS u(i) WHERE len(words) > 0),
doc AS (SELECT doc_id, {_WORDS7} AS words FROM documents),
place AS (
  SELECT doc_id, i, l.n, words[i:i + l.n - 1] AS w
  FROM doc, (SELECT DISTINCT n FROM window_) l, range(1, greatest(len(words) - l.n + 2, 1)) AS u(i)),
hit AS (SELECT doc_id, i, place.n, item FROM place JOIN window_ ON place.w = window_.w),
word AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, range(0, n) AS u(j) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)
"""

def _components(words: int, kept: str = "") -> str:
    """Documents by components of the similarity of their sets of ``words``-word shingles."""
    return rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
    range(1, greatest(len(w) - {words - 2}, 2)), lambda i: array_to_string(w[i:i + {words - 1}], ' ')))) END AS s FROM split),
sets AS (SELECT s, min(doc_id) AS least, row_number() OVER (ORDER BY s) AS k FROM shingled WHERE len(s) > 0 GROUP BY s),
one AS (SELECT k, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.k AS a, b.k AS b FROM one a JOIN one b ON a.x = b.x AND a.k <> b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (
  SELECT k AS a, k AS b FROM sets
  UNION SELECT reached.a, pairs.b FROM reached JOIN pairs ON reached.b = pairs.a),
named AS (SELECT reached.a AS k, min(least) AS component_id FROM reached JOIN sets ON sets.k = reached.b GROUP BY reached.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id{kept}
FROM shingled LEFT JOIN sets USING (s) LEFT JOIN named USING (k)
"""


OP1 = _components(5)
OP12 = _components(2, ", doc_id IS NOT DISTINCT FROM coalesce(component_id, doc_id) AS kept")

OP11 = """
WITH taken AS (
  SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
rows_ AS (SELECT *, row_number() OVER (ORDER BY vec_id, label, v) AS r FROM taken),
scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CASE WHEN len(a.v) = 0 THEN 0 ELSE list_inner_product(a.v, b.v) END::BIGINT AS score
  FROM rows_ a JOIN rows_ b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS p FROM scored WHERE same) WHERE p <= 5),
found AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.p ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
  FROM positives p JOIN scored n ON p.a = n.a AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 3
"""

OP13 = f"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS d, {_WORDS7} AS words FROM documents),
sized AS (SELECT *, len(words) AS n FROM doc WHERE len(words) > 0),
total AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM sized),
item AS (SELECT item_id, row_number() OVER () AS i, {_WORDS7} AS words FROM benchmark),
asked AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(words) AS term FROM item) GROUP BY ALL),
held AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(words) AS term FROM sized)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, total GROUP BY term),
scored AS (
  SELECT i, item_id, d, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weight USING (term) JOIN sized USING (d) CROSS JOIN total GROUP BY i, item_id, d, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


ORACLES: dict[str, str] = {
    "op1_ngram_join": OP1,
    "op7_decontamination": OP7,
    "op9_source_mixing": OP9,
    "op10_quality_rules": OP10,
    "op11_hard_negatives": OP11,
    "op12_near_duplicates": OP12,
    "op13_lexical_search": OP13,
}
