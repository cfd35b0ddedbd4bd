"""The registered queries of the operators, with their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm import (
    bagminhash,
    chunk_table,
    collocations,
    cross_polytope,
    licenses,
    mixing,
    quality,
    rlz,
    segment_search,
    spelling,
    suffix_dedup,
    toxicity,
    warc,
)
from platewise.llm.common import table
from platewise.session import configure, staged_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (session, folder) under its own name."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder)

        QUERIES[build.__name__] = run
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


# ---------------------------------------------------------------- 1: substrings by Lempel-Ziv parsing


@query(
    """WITH d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents
), s AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM d, unnest(range(1, len(w) - 18)) AS u(i) WHERE len(w) >= 20
), r AS (SELECT doc_id, i FROM s QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1
), g AS (SELECT DISTINCT doc_id, i + k AS i FROM r, unnest(range(20)) AS v(k)
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), k AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM (
    SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) AS a ANTI JOIN g USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)"""
)
def op1_relative_lempel_ziv(spark, folder):
    cut = rlz.dedup(table(spark, folder, "documents", "doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# ---------------------------------------------------------------- 2: toxicity

# The chain over the labels at hand: junk first, as what it says helps to tell insults.
CATEGORIES = ["junk", "toxic"]


def toxicity_chain(docs: DataFrame, labels: DataFrame) -> toxicity.Chain:
    marked = labels.select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    return toxicity.fit(docs, marked, CATEGORIES)


@query()
def op2_toxicity(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    chain = toxicity_chain(docs, table(spark, folder, "labels", "doc_id", "quality", "toxic"))
    return chain.score(docs).withColumn("toxic", F.col("p_toxic") >= toxicity.THRESHOLD)


# ---------------------------------------------------------------- 3: near duplicates


@query(
    """WITH RECURSIVE d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents
), k AS (SELECT array_to_string(w, ' ') AS t, any_value(w) AS w, row_number() OVER () AS node FROM d WHERE len(w) > 0 GROUP BY t
), s AS (
  SELECT node, md5(array_to_string(w[i:i + least(5, len(w)) - 1], ' ')) AS g, count(*) AS c
  FROM k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS u(i) GROUP BY node, g
), z AS (SELECT node, sum(c) AS n FROM s GROUP BY node
), p AS (
  SELECT a.node AS a, b.node AS b, sum(least(a.c, b.c)) AS common FROM s AS a JOIN s AS b ON a.g = b.g AND a.node < b.node GROUP BY a.node, b.node
), l AS (
  SELECT a, b FROM p JOIN z AS x ON a = x.node JOIN z AS y ON b = y.node WHERE 10 * common >= 8 * (x.n + y.n - common)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (SELECT node AS a, node AS b FROM k UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
), c AS (SELECT a AS node, min(b) AS part FROM r GROUP BY a
), m AS (
  SELECT d.doc_id, coalesce('t' || CAST(part AS VARCHAR), 'd' || CAST(d.doc_id AS VARCHAR)) AS part
  FROM d LEFT JOIN k ON array_to_string(d.w, ' ') = k.t LEFT JOIN c ON k.node = c.node
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY part) AS class_id, count(*) OVER (PARTITION BY part) AS class_size FROM m"""
)
def op3_near_duplicates(spark, folder):
    return bagminhash.classes(table(spark, folder, "documents", "doc_id", "text"))


# ---------------------------------------------------------------- 4: repeated byte strings


@query(
    """WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS x FROM documents
), u AS (
  SELECT r, unnest([struct_pack(i := i, h := md5_number(substr(x, 2 * i + 1, 800))) FOR i IN range(0, CAST(length(x) // 2 - 399 AS BIGINT))]) AS s FROM d
), t AS (SELECT r, s.i AS i FROM u QUALIFY count(*) OVER (PARTITION BY s.h) > 1
), g AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS n, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM t
), o AS (
  SELECT r, sum(least(400, coalesce(n - i, 400))) AS removed, count(*) FILTER (p IS NULL OR i - p > 400) AS spans FROM g GROUP BY r
), s AS (SELECT r, CASE WHEN p IS NULL THEN 0 ELSE p + 400 END AS a, i AS b FROM g WHERE p IS NULL OR i - p > 400
  UNION ALL SELECT g.r, i + 400, length(x) // 2 FROM g JOIN d ON g.r = d.r WHERE n IS NULL
), k AS (SELECT s.r, string_agg(substr(x, 2 * CAST(a AS BIGINT) + 1, 2 * CAST(b - a AS BIGINT)), '' ORDER BY a) AS kept FROM s JOIN d ON s.r = d.r GROUP BY s.r
)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM d LEFT JOIN o ON d.r = o.r LEFT JOIN k ON d.r = k.r"""
)
def op4_prefix_doubling(spark, folder):
    cut = suffix_dedup.dedup(table(spark, folder, "documents", "doc_id", "text"))
    spans = F.size("spans").cast("bigint").alias("n_spans")
    return cut.select("doc_id", "n_bytes", "n_removed", spans, F.sha2("kept", 256).alias("kept_sha256"))


# ---------------------------------------------------------------- 5: WARC


@query(
    """SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to
  FROM (
    SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS f, (
      SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(list_reduce(
        [CAST(x AS INTEGER) FOR x IN string_split(substr(b, 1 + 5 * i, 5), '')], lambda a, x: 2 * a + x) AS BIGINT) + 1, 1), ''
        ORDER BY i) FROM unnest(range(32)) AS u(i)) AS d
    FROM (SELECT *, array_to_string([right(bin(CAST(('0x' || x) AS INTEGER) + 16), 4) FOR x IN string_split(
                 sha1(coalesce(html, '')), '')], '') AS b FROM pages))"""
)
def op5_warc(spark, folder):
    path = staged_path(spark, "archives")
    warc.write(table(spark, folder, "pages", "page_id", "url", "html"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# ---------------------------------------------------------------- 6: nearest neighbours


@query()
def op6_cross_polytope(spark, folder):
    rows = table(spark, folder, "embeddings", "vec_id", "embedding")
    return cross_polytope.search(rows, F.col("key") % 20 == 0)


# ---------------------------------------------------------------- 7: SentencePiece

# The vocabulary is a parameter of the operator; the registered query uses the public one.
PIECES = "piece_bpe_32k.model"


def piece_model() -> bytes:
    import public_tokenizers

    return chunk_table.model_bytes(public_tokenizers.path(PIECES))


@query()
def op7_sentencepiece(spark, folder):
    model = piece_model()
    encoded = chunk_table.encode(table(spark, folder, "documents", "doc_id", "text"), model)
    return chunk_table.decode(encoded, model).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


# ---------------------------------------------------------------- 8: mixing


def _time_sql() -> str:
    """mixing.time_of for a demand u of schedule ``class``."""
    cases = []
    for number, knots in enumerate(mixing.SCHEDULES):
        sums, parts = mixing.integral(knots), len(knots) - 1
        y = f"(u * {sums[-1]!r}::DOUBLE)"
        steps = []
        for j in range(parts):
            rest = f"({y} - {sums[j]!r}::DOUBLE)"
            root = f"sqrt({knots[j] ** 2!r}::DOUBLE + {2.0 * (knots[j + 1] - knots[j]) * parts!r}::DOUBLE * {rest})"
            step = f"{j / parts!r}::DOUBLE + 2.0::DOUBLE * {rest} / ({knots[j]!r}::DOUBLE + {root})"
            steps.append(f"WHEN {y} >= {sums[j]!r}::DOUBLE THEN {step}" if j else f"ELSE {step}")
        cases.append(f"WHEN class = {number} THEN CASE {' '.join([*reversed(steps[1:]), steps[0]])} END")
    return f"least(CASE {' '.join(cases)} END, 1.0::DOUBLE)"


def _mixing_sql() -> str:
    weights = [mixing.integral(knots)[-1] for knots in mixing.SCHEDULES]
    weight = " ".join(f"WHEN {number} THEN {value!r}::DOUBLE" for number, value in enumerate(weights))
    return f"""WITH z AS (
  SELECT doc_id, source, len([x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw FROM documents
), s AS (
  SELECT source, sum(size)::DOUBLE AS words, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} AS class
  FROM z GROUP BY source
), w AS (SELECT *, CASE class {weight} END AS weight, words * 2.0 AS most FROM s
), o AS (
  SELECT *, 1.5 * sum(words) OVER () AS wanted, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS k FROM w
), l AS (
  SELECT *, (wanted - coalesce(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o
), c AS (SELECT *, level * weight > most AS over FROM l
), f AS (
  SELECT coalesce(sum(most) FILTER (over), 0.0) AS capped, sum(weight) FILTER (NOT over) AS free FROM c
), t AS (
  SELECT source, words, class, CASE WHEN over THEN most ELSE ((wanted - capped) / free) * weight END AS target FROM c, f
), p AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(words AS BIGINT) AS source_size, target, class, words,
         coalesce(sum(size) OVER (PARTITION BY z.source ORDER BY draw, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS start
  FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source
), q AS (SELECT *, CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END AS whole FROM p
), r AS (SELECT *, greatest(0, least(size, floor(target - whole * words + 0.5) - start)) AS part FROM q
), v AS (SELECT *, CAST(whole * size + part AS BIGINT) AS taken,
         (CASE WHEN whole > 0 THEN start ELSE whole * words + start END) / target AS u FROM r
)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN {_time_sql()} END AS position FROM v"""


@query(_mixing_sql())
def op8_mixing(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents", "doc_id", "text", "source"))
    placed = mixed.withColumn("position", F.get("passes", F.lit(0))["position"]).drop("passes")
    return placed.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


# ---------------------------------------------------------------- 9: quality rules


def _quality_sql() -> str:
    tests = []
    for rule in quality.THRESHOLDS:
        value = rule.over if rule.under is None else f"CAST({rule.over} AS DOUBLE) / nullif({rule.under}, 0)"
        both = [f"{value} >= {rule.low}"] * (rule.low is not None) + [f"{value} <= {rule.high}"] * (rule.high is not None)
        tests.append(f"(coalesce({' AND '.join(both)}, FALSE) OR n_words < {rule.from_words}) AS {rule.name}")
    names = " AND ".join(rule.name for rule in quality.THRESHOLDS)
    stop = ", ".join(f"'{word}'" for word in quality.STOP_WORDS)
    return f"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
  FROM documents
), s AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, len(w) - 3)) AS u(i) WHERE len(w) >= 5
), dup AS (SELECT doc_id, i FROM s QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, unnest(range(5)) AS v(k) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len([x FOR x IN w IF lower(x) IN ({stop})]) AS BIGINT) AS n_stop_words,
         CAST(len([x FOR x IN lines IF regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•]')]) AS BIGINT) AS n_bullet_lines,
         CAST(len([x FOR x IN lines IF regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$')]) AS BIGINT) AS n_ellipsis_lines
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id
), j AS (
  SELECT *, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed, {', '.join(tests)} FROM m
)
SELECT *, NOT base_failed AND {names} AS kept FROM j"""


@query(_quality_sql())
def op9_quality_rules(spark, folder):
    return quality.judge(quality.measures(table(spark, folder, "documents", "doc_id", "text")))


# ---------------------------------------------------------------- 10: licence scans


def _licenses_sql() -> str:
    rows = ", ".join(
        f"('{name}', [{', '.join(repr(gram) for gram in licenses.template_bigrams(body))}])"
        for name, body in sorted(licenses.TEMPLATES.items())
    )
    return f"""WITH t(license, grams) AS (VALUES {rows}),
d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
u AS (
  SELECT r, unnest(string_split(text, chr(10))) AS unit FROM d
  UNION ALL SELECT r, replace(text, chr(10), ' ') FROM d WHERE contains(text, chr(10))
), w AS (
  SELECT r, [x FOR x IN regexp_split_to_array(lower(unit), '[^\\p{{L}}\\p{{N}}]+') IF x <> ''] AS w FROM u
), b AS (
  SELECT r, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g FROM w WHERE len(w) BETWEEN 2 AND 400
), s AS (
  SELECT r, license, 2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS score FROM b, t
  WHERE len(g) BETWEEN len(grams) / 2 AND len(grams) * 2
), f AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
         min(struct_pack(s := -score, l := license)) AS best FROM s WHERE score >= {licenses.DICE} GROUP BY r
)
SELECT doc_id, coalesce(licenses, '') AS licenses, best.l AS license, -best.s AS score FROM d LEFT JOIN f ON d.r = f.r"""


@query(_licenses_sql())
def op10_license_scan(spark, folder):
    found = licenses.scan(table(spark, folder, "documents", "doc_id", "text"))
    return found.withColumn("licenses", F.array_join("licenses", ","))


# ---------------------------------------------------------------- 11: spelling variants


@query(
    """WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), d AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents
), o AS (SELECT id, w, count(*) AS n FROM d GROUP BY id, w HAVING length(w) >= 5
), h AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295, flatten([
      CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END FOR x IN string_split(id || ':' || w, '')])),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM o, t
), v AS (
  SELECT CASE WHEN h % 97 = 0 THEN w[:CAST(h % length(w) AS BIGINT)] || w[CAST(h % length(w) AS BIGINT) + 2:] ELSE w END AS word, n FROM h
), w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), x AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS less FROM w, unnest(range(1, length(word) + 1)) AS u(i)
), p AS (
  SELECT a.word, b.word AS near, b.n AS n_of FROM x AS a JOIN x AS b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT x.word, w.word, w.n FROM x JOIN w ON less = w.word
  UNION SELECT w.word, x.word, x.n FROM x JOIN w ON less = w.word
), f AS (
  SELECT word, count(*) AS n_near, min(struct_pack(s := -n_of, w := near)) AS best FROM p GROUP BY word
), g AS (
  SELECT w.word, CASE WHEN -best.s >= 2 * n THEN best.w END AS form, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN -best.s >= 2 * n THEN -best.s END AS form_n FROM w LEFT JOIN f ON w.word = f.word
), r AS (
  SELECT word, form AS at FROM g WHERE form IS NOT NULL
  UNION SELECT r.word, g.form FROM r JOIN g ON r.at = g.word WHERE g.form IS NOT NULL
), e AS (SELECT r.word, r.at FROM r JOIN g ON r.at = g.word WHERE g.form IS NULL
)
SELECT g.word, form, coalesce(e.at, g.word) AS root, n, n_near, form_n FROM g LEFT JOIN e ON g.word = e.word"""
)
def op11_spelling_variants(spark, folder):
    return spelling.group(table(spark, folder, "documents", "doc_id", "text"))


# ---------------------------------------------------------------- 12: collocations


@query(
    """WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS r,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), q AS (
  SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS w FROM (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
), g AS (
  SELECT lang, k, w[i:i + k - 1] AS p FROM q, unnest(range(1, 4)) AS s(k), unnest(range(1, len(w) + 1)) AS u(i) WHERE i + k - 1 <= len(w)
), f AS (SELECT lang, k, p, count(*) AS c FROM g GROUP BY lang, k, p HAVING count(*) >= 10
), n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM q GROUP BY lang
), c AS (
  SELECT f.lang, f.k, f.p, f.c AS a, h AS cut, x.c AS l, y.c AS r,
         CAST(1000000::HUGEINT * f.c * f.c // (x.c::HUGEINT * y.c) AS BIGINT) AS score
  FROM f, unnest(range(1, f.k)) AS s(h) JOIN f AS x ON x.lang = f.lang AND x.p = f.p[:h] JOIN f AS y ON y.lang = f.lang AND y.p = f.p[h + 1:]
  WHERE f.k > 1
), b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), o AS (
  SELECT lang, p[:2] AS p, c FROM f WHERE k = 3 UNION ALL SELECT lang, p[2:], c FROM f WHERE k = 3
), s AS (SELECT lang, p, max(c) AS c FROM o GROUP BY lang, p
), z AS (
  SELECT b.lang, array_to_string(b.p, ' ') AS phrase, a, l, r, score FROM b LEFT JOIN s ON b.lang = s.lang AND b.p = s.p
  WHERE 100 * coalesce(s.c, 0) < 50 * a
)
SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM z JOIN n ON z.lang = n.lang QUALIFY rank <= 2000"""
)
def op12_collocations(spark, folder):
    return collocations.mine(table(spark, folder, "documents", "text", "lang"))


# ---------------------------------------------------------------- 13: exact top-k


@query(
    """WITH e AS (
  SELECT vec_id, min(embedding) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 GROUP BY vec_id
), v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN e] AS v FROM e
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum([x * a.v[i] FOR x, i IN b.v]) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""
)
def op13_segment_search(spark, folder):
    return segment_search.search(table(spark, folder, "embeddings", "vec_id", "embedding"), F.col("key") % 50 == 0)
