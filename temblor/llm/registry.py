"""The operators of this subpackage as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temblor.llm import (
    forest,
    htmlcrf,
    importance,
    merkle,
    minhash,
    mixing,
    packing,
    pii,
    quality,
    secrets,
    separators,
    warc,
    winnow,
)
from temblor.llm.frames import OWN, table, written


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlcrf.extract(table(spark, sf_dir, "pages"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = f"{OWN}m"
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = written(quality.measured(docs, m).drop("text"), "measures")
    cutoffs = quality.fit_cutoffs(rows, table(spark, sf_dir, "labels"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality.judged(rows, cutoffs).select(
        "doc_id",
        *[F.col(f"{m}.{c}").alias(c) for c in base],
        quality.base_failed(F.col(m)).alias("base_failed"),
        F.col(f"{OWN}kept").alias("kept"),
    )


def op5_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separators.token_counts(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs).select("doc_id", "secrets.*")


def op8_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op9_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"))


def op10_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.keyed(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
    return mixing.placed(rows).select(
        "doc_id",
        "source",
        F.col(f"{OWN}size").alias("n_chars"),
        F.col(f"{OWN}block").alias("block"),
        F.col(f"{OWN}offset").alias("block_offset"),
        F.col(f"{OWN}slot").alias("slot"),
    )


def op11_crc_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.tampered())


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.chained(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_transactions": op1_warc_transactions,
    "op2_crf_main_text": op2_crf_main_text,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_separator_scan": op5_separator_scan,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_assignment_secrets": op7_assignment_secrets,
    "op8_contextual_pii": op8_contextual_pii,
    "op9_prefix_forest": op9_prefix_forest,
    "op10_pfair_mixing": op10_pfair_mixing,
    "op11_crc_importance": op11_crc_importance,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_winnowing": op13_winnowing,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Five hexadecimal digits of the SHA-1 make four digits of base 32.
_BASE32 = " || ".join(
    f"substr('{_UPPER}234567', 1 + CAST((d[{i}] // {32 ** (3 - j)}) % 32 AS INTEGER), 1)"
    for i in range(1, 9)
    for j in range(4)
)

_SPACE = "\\x20\\x09-\\x0D"
_RISK = quality.Risk()
_CUTOFFS = ", ".join(
    f"({n}, '{rule.name}', CAST({c} AS DOUBLE))" for n, rule in enumerate(quality.RULES) for c in rule.cutoffs
)
_VALUES = ", ".join(f"{rule.part} / greatest({rule.whole}, 1)" for rule in quality.RULES)

# Cutoffs by exact binomial tests, from the most lenient on, and their verdict.
_QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^{_SPACE}]+') AS ws,
             [l FOR l IN string_split(t, chr(10)) IF regexp_matches(l, '[^{_SPACE}]')] AS ls FROM d),
g AS (SELECT r, unnest([ws[i:i + 2] FOR i IN range(1, len(ws) - 1)]) AS g, unnest(range(1, len(ws) - 1)) AS i FROM w),
c AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words
      FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g), (SELECT unnest([0, 1, 2]) AS k)
      WHERE n > 1 GROUP BY r),
m AS (SELECT r, doc_id, lang, len(ws) AS n_words,
             length(regexp_replace(t, '[{_SPACE}]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
             length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower,
             len(ls) AS n_lines, length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks
      FROM w LEFT JOIN c USING (r)),
v AS (SELECT m.*, [{_VALUES}] AS v FROM m),
h AS (SELECT v.lang, v.v, q.good FROM v JOIN (
        SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) q USING (doc_id)),
k AS (SELECT lang, rule, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND v[1 + rule] > cutoff) AS lost,
             count(*) FILTER (NOT good AND v[1 + rule] > cutoff) AS won
      FROM h, (VALUES {_CUTOFFS}) AS t(rule, name, cutoff) GROUP BY lang, rule, cutoff),
b AS (SELECT {_RISK.risk / len(quality.RULES)}::DOUBLE AS p,
             {_RISK.error / len(quality.RULES)}::DOUBLE / greatest(1, (SELECT count(*) FROM (SELECT DISTINCT lang FROM h))) AS e),
o AS (SELECT k.*, lost <= p * n AND n > 0 AND list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                + i * ln(p) + (n - i) * ln(1 - p)) FOR i IN range(0, lost + 1)]) <= e AS proven FROM k, b),
s AS (SELECT *, bool_and(proven) OVER (PARTITION BY lang, rule ORDER BY cutoff DESC) AS open,
             won - {_RISK.price}::DOUBLE * lost AS gain FROM o),
x AS (SELECT lang, rule, cutoff FROM s WHERE open AND gain > 0
      QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, cutoff DESC) = 1),
y AS (SELECT v.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             EXISTS (SELECT 1 FROM x WHERE x.lang IS NOT DISTINCT FROM v.lang AND v.v[1 + x.rule] > x.cutoff) AS rejected
      FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept FROM y"""

def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a column, byte by byte through the table."""
    table = importance.crc_table().tolist()
    octets = f"[CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT) FOR i IN range(strlen({text}))]"
    step = f"xor(list_extract({table}, CAST(1 + xor(c & 255, b) AS INTEGER)), c >> 8)"
    ones = "CAST(4294967295 AS BIGINT)"
    return f"xor(list_reduce(list_prepend({ones}, {octets}), lambda c, b: {step}), {ones})"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


_WORDS = f"regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# Runs of one to three words, their buckets, gains, and the draw by weight and noise.
_IMPORTANCE = f"""
WITH w AS (SELECT 'd' AS side, row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents
           UNION ALL SELECT 'b', NULL, NULL, {_WORDS} FROM benchmark),
f AS (SELECT side, r, unnest(ws) AS f FROM w
      UNION ALL SELECT side, r, unnest([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) FROM w
      UNION ALL SELECT side, r, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)]) FROM w),
k AS (SELECT f, {_crc32("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM f)),
c AS (SELECT side, r, bucket, count(*) AS n FROM f JOIN k USING (f) GROUP BY side, r, bucket),
g AS (SELECT bucket, floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (sum(s) OVER () + 10000) / (CAST(s + 1 AS DOUBLE) * (sum(t) OVER () + 10000)))) AS gain
      FROM (SELECT b.bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
            FROM range(10000) AS b(bucket) LEFT JOIN c USING (bucket) GROUP BY b.bucket)),
v AS (SELECT r, sum(n) AS n_features, sum(n * gain) AS weight FROM c JOIN g USING (bucket) WHERE side = 'd' GROUP BY r),
x AS (SELECT r, doc_id, len(ws) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) AS h FROM w LEFT JOIN v USING (r) WHERE side = 'd'),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
z AS (SELECT r, row_number() OVER (ORDER BY score DESC NULLS LAST, doc_id) AS rank, count(*) OVER () AS n FROM y WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 AND score IS NOT NULL THEN rank END AS rank
FROM y LEFT JOIN z USING (r)"""


def _tree(name: str, levels: int) -> tuple[str, str]:
    """Levels of the trees whose leaves ``name0`` has as ``tree``, ``i``, ``d``: nodes with their tree's
    width ``c`` and the texts of their siblings, and the steps of a path ``{name}p0`` through them."""
    nodes, paths = [], []
    for k in range(levels + 1):
        nodes.append(
            f"{name}{k}s AS (SELECT a.tree, a.i, a.c, any_value(a.d) AS d,"
            " coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,"
            " coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r"
            f" FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM {name}{k}) a"
            f" JOIN {name}{k} b ON a.tree = b.tree AND a.i // 8 = b.i // 8 GROUP BY a.tree, a.i, a.c)"
        )
        if k < levels:
            nodes.append(
                f"{name}{k + 1} AS (SELECT tree, i // 8 AS i, CASE WHEN c > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE min(d) END AS d"
                f" FROM {name}{k}s GROUP BY tree, i // 8, c)"
            )
            paths.append(
                f"{name}p{k + 1} AS (SELECT p.* REPLACE (p.i // 8 AS i, proof || l || r AS proof,"
                f" CASE WHEN c > 1 THEN sha256(l || node || r) ELSE node END AS node)"
                f" FROM {name}p{k} p JOIN {name}{k}s s ON p.tree = s.tree AND p.i = s.i)"
            )
    return ",\n".join(nodes), ",\n".join(paths)


_FIELDS = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in merkle.FIELDS)
_CHANGED = _FIELDS.replace("text", _lower("text"))
_LEVELS, _UPPER_LEVELS = 7, 3
_LEAF_NODES, _LEAF_PATHS = _tree("t", _LEVELS)
_ROOT_NODES, _ROOT_PATHS = _tree("u", _UPPER_LEVELS)
_MERKLE = f"""
WITH d AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, sha256({_FIELDS}) AS leaf,
                  CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN sha256({_CHANGED}) ELSE sha256({_FIELDS}) END AS now FROM documents),
e AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
t0 AS (SELECT tree, i, leaf AS d FROM e),
{_LEAF_NODES},
tp0 AS (SELECT doc_id, tree, i, leaf, now AS node, '' AS proof FROM e),
{_LEAF_PATHS},
u0 AS (SELECT 0 AS tree, tree AS i, d FROM t{_LEVELS}),
{_ROOT_NODES},
up0 AS (SELECT doc_id, 0 AS tree, tree AS i, leaf, node, proof, tree AS lang FROM tp{_LEVELS}),
{_ROOT_PATHS}
SELECT doc_id, leaf, t.d AS subroot, u.d AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = u.d AS verified
FROM up{_UPPER_LEVELS} p JOIN t{_LEVELS} t ON t.tree = p.lang CROSS JOIN u{_UPPER_LEVELS} u"""


def _likeness(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE {both}::DOUBLE / (len({a}) + len({b}) - {both}) END"


def _winnowing(how: winnow.Winnow = winnow.Winnow()) -> str:
    """Gram hashes by doubling, then the least of each window, with its position in the low bits."""
    mask = "18446744073709551615::UHUGEINT"
    steps, power, length = [], winnow.BASE, 1
    while length < how.gram:
        following = f"lead(h, {length}, 0::UHUGEINT) OVER (PARTITION BY k ORDER BY i)"
        steps.append(f"h{2 * length} AS (SELECT k, i, n, (h * {power}::UHUGEINT + {following}) & {mask} AS h FROM h{length}),")
        power, length = power * power % 2**64, 2 * length

    def mix(h: str) -> str:
        a = f"CAST({h} AS UBIGINT)"
        b = f"CAST(xor({a}, {a} >> 32)::UHUGEINT * {winnow.MIX}::UHUGEINT & {mask} AS UBIGINT)"
        return f"xor({b}, {b} >> 29)"

    newline = "\n"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(doc_id) OVER o, min(doc_id) OVER ()) AS next_id, length(t) // 4 AS q,
             coalesce(lead(t) OVER o, first_value(t) OVER (ORDER BY doc_id)) AS u FROM d WINDOW o AS (ORDER BY doc_id)),
e AS (SELECT doc_id, next_id, length(t) AS n_chars, t, substr(t, 1, length(t) - q) || substr(u, 1, q) AS s FROM n),
x AS (SELECT 2 * doc_id AS k, regexp_extract_all(t, '(?s).') AS cs FROM e
      UNION ALL SELECT 2 * doc_id + 1, regexp_extract_all(s, '(?s).') FROM e),
h1 AS (SELECT k, unnest(range(len(cs))) AS i, unicode(unnest(cs))::UHUGEINT AS h, len(cs) - {how.gram} + 1 AS n
       FROM x WHERE len(cs) >= {how.gram}),
{newline.join(steps)}
m AS (SELECT k, i, n, {mix("h")} AS h FROM h{how.gram} WHERE i < n),
p AS (SELECT k, i, n, min(h::UHUGEINT * 16777216::UHUGEINT + (16777215 - i)::UHUGEINT) OVER (
               PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND {how.window - 1} FOLLOWING) AS v FROM m),
g AS (SELECT DISTINCT k, CAST(v // 16777216::UHUGEINT AS UBIGINT) AS h, 16777215 - CAST(v % 16777216::UHUGEINT AS BIGINT) AS i
      FROM p WHERE i <= greatest(n - {how.window}, 0)
      UNION ALL SELECT k, {mix("z")}, 0 FROM (
        SELECT k, list_reduce([unicode(c)::UHUGEINT FOR c IN cs], lambda a, b: (a * {winnow.BASE}::UHUGEINT + b) & {mask}) AS z
        FROM x WHERE len(cs) BETWEEN 1 AND {how.gram - 1})),
f AS (SELECT k, string_agg(lpad(lower(hex(h)), 16, '0') || ':' || i, ',' ORDER BY i) AS f, list(DISTINCT h) AS hs FROM g GROUP BY k),
a AS (SELECT e.*, coalesce(o.f, '') AS fingerprint, coalesce(v.f, '') AS edited_fingerprint,
             coalesce(o.hs, []) AS oh, coalesce(v.hs, []) AS vh, coalesce(w.hs, []) AS wh
      FROM e LEFT JOIN f o ON o.k = 2 * doc_id LEFT JOIN f v ON v.k = 2 * doc_id + 1 LEFT JOIN f w ON w.k = 2 * next_id)
SELECT doc_id, n_chars, sha256(s) AS edited_sha256, fingerprint, edited_fingerprint,
       {_likeness("oh", "vh")} AS near_edited, {_likeness("oh", "wh")} AS near_next FROM a"""


ORACLE: dict[str, str] = {
    "op11_crc_importance": _IMPORTANCE,
    "op12_merkle_manifest": _MERKLE,
    "op13_winnowing": _winnowing(),
    "op4_quality_rules": _QUALITY,
    "op1_warc_transactions": f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first,
             [CAST('0x' || substr(sha1(html), 1 + 5 * i, 5) AS BIGINT) FOR i IN range(8)] AS d FROM p)
SELECT page_id, url, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d""",
    "op3_minhash_near_dedup": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]) END AS sh
      FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
l AS (SELECT a.doc_id AS i, b.doc_id AS j FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, l.j FROM r JOIN l ON r.other = l.i)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(other) AS component_id, s.doc_id = min(other) AS kept
FROM s JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id, sh""",
}
