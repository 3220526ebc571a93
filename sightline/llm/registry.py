"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the counts of the three base kinds, the digest of the base spans and all spans, per row of documents. A null or empty text has no spans (an empty list and the digest of one); repeated rows each have a row."""
    from .secret_scan import BASE, scan, written

    out = scan(_table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"] < len(BASE))

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    n = [count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    return out.select("doc_id", *n, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, main text and its length in code points, per row of pages. Null, empty and textless pages have an empty text and n_chars 0."""
    from .html_text import extract

    return extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per piece of a document: bin_id, doc_id, piece, start_word, n_words. Near-duplicate classes are the clusters. A null, empty or wordless text is one piece of no words; repeated rows are copies, which never share a bin."""
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"), near=True)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload length and digest, record type and the page referred to, per row of pages, as read back from the archives. A null html is an empty payload; rows of one id are each a record."""
    from .warc import new_folder, read, write

    folder = new_folder(spark)
    files = write(_table(spark, sf_dir, "pages"), folder)
    return read(spark, folder, files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, license, containment and start_word, per row of documents and template that it holds. Texts that are null or have under five words hold none."""
    from .license_scan import scan

    return scan(_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, similarity and start_word, per row of documents and benchmark item that a window of it repeats. Null and wordless texts and items match nothing."""
    from .decontaminate import find_leaks

    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words, per row of documents. A null or wordless text has 0 words and the digest of an empty text; repeated rows count as repeats of each other."""
    from .substring_dedup import remove_repeated_windows

    out = remove_repeated_windows(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted, per row of documents; the score is learnt without the held-out quarter of the ids. Null and empty texts get the share of label 1 among such training rows; a null doc_id is not held out."""
    from .quality_crf import fit, score

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    out = score(docs, fit(docs, labels, learn_from=~held_out))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and class_id, the smallest doc_id of its near-duplicate class, per row of documents. Null, empty and wordless texts are their own class; a null doc_id keeps its row and its class."""
    from .near_dedup import near_duplicate_classes

    return near_duplicate_classes(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the rule counts, base_failed, kept and the anomaly score, per row of documents. A null or empty text has counts of 0 and fails; without labelled rows the base rules alone decide."""
    from .quality_rules import fit, rate

    docs = _table(spark, sf_dir, "documents")
    out = rate(docs, fit(docs, _table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the number of runs, the longest one (ties: smallest start, then period; nulls without runs) and the digests of all runs and of the collapsed words, per row of documents. Tails of a tenth of the texts are made periodic first. Null and wordless texts have no runs and the digests of nothing."""
    from .periodic_runs import find_runs, with_periodic_tails

    out = find_runs(with_periodic_tails(_table(spark, sf_dir, "documents")))
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))), 1)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    out = out.withColumn("best", F.when(F.size("runs") > 0, best))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length and digest of each piece, its document's ids, its sequence and its place there, for all documents in sequences of at most 2,048 ids. A null or empty text is one piece of one id; repeated rows are each a document."""
    import public_tokenizers

    from .token_packing import pack_tokens

    out = pack_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, per usable row of embeddings and component. Rows with a null vector or null or non-finite entries have no rows; whitened is null for a component without variance; deviation is null beyond 63 bits."""
    from .whitening import fit_whitening, identity_error, whiten

    fit = fit_whitening(_table(spark, sf_dir, "embeddings"))
    explained = [float(v / fit.trace) if fit.trace > 0 else 0.0 for v in fit.values]
    parts = F.posexplode(F.zip_with("whitened", F.array(*map(F.lit, explained)).cast("array<double>"), lambda w, e: F.struct(w.alias("whitened"), e.alias("explained")))).alias("at", "v")
    out = whiten(fit).select("vec_id", F.col("deviation").try_cast("long").alias("deviation"), parts)
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", F.col("v.whitened").alias("whitened"),
        F.col("v.explained").alias("explained"), F.lit(identity_error(fit)).alias("identity_error"),
    )


def _secret_sql() -> str:
    from .secret_scan import ADDED, BASE

    rules = (*BASE, *ADDED)
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    lists = ", ".join(
        f"""list_filter(list_transform(range(len(regexp_extract_all(t, {quote(r.pattern)}))), lambda k: [
        coalesce(list_sum(list_transform(string_split_regex(t, {quote(r.pattern)})[1 : k + 1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(regexp_extract_all(t, {quote(r.pattern)})[1 : k], lambda x: length(x))), 0),
        {n}, length(regexp_extract_all(t, {quote(r.pattern)})[k + 1]), length(regexp_extract_all(t, {quote(r.pattern)}, {r.group})[k + 1])]), lambda s: s[4] >= {r.least})"""
        for n, r in enumerate(rules)
    )
    names = "[" + ", ".join(f"'{r.kind}'" for r in rules) + "]"
    text = lambda xs: f"array_to_string(list_transform({xs}, lambda s: concat({names}[CAST(s[2] AS BIGINT) + 1], ':', CAST(s[1] AS BIGINT), ':', CAST(s[1] + s[3] AS BIGINT))), ',')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id, list_sort(flatten([{lists}])) AS s FROM d)
SELECT doc_id, {", ".join(f"CAST(len(list_filter(s, lambda x: x[2] = {k})) AS BIGINT) AS n_{r.kind}" for k, r in enumerate(BASE))},
  sha256({text(f"list_filter(s, lambda x: x[2] < {len(BASE)})")}) AS base_sha256, {text("s")} AS spans
FROM f
"""


OP5_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, lower(sha1(b)) AS payload_digest, max(page_id) OVER (PARTITION BY b) AS largest FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to
FROM q
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(len(w) - 34)) AS i, w FROM d WHERE len(w) >= 35),
k AS (SELECT doc_id, i, md5(array_to_string(w[i + 1 : i + 35], ' ')) AS h FROM p),
r AS (SELECT doc_id, i FROM k WHERE h IN (SELECT h FROM k GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
g AS (SELECT doc_id, list(j) AS js FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE list_filter(w, lambda x, n: NOT list_contains(js, n - 1)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""


OP9_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' ')) END AS ss FROM d WHERE len(w) > 0),
u AS (SELECT min(doc_id) AS doc_id, ss, sum(1) AS copies FROM s GROUP BY ss),
c AS (SELECT doc_id, x, count(*) AS n FROM (SELECT doc_id, unnest(ss) AS x FROM u) GROUP BY ALL),
t AS (SELECT doc_id, sum(n) AS total FROM c GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS shared FROM c a JOIN c b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN t ta ON ta.doc_id = a JOIN t tb ON tb.doc_id = b WHERE shared >= 0.8 * (ta.total + tb.total - shared)),
g AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(n, m) AS (SELECT doc_id, doc_id FROM u UNION SELECT r.n, g.b FROM r JOIN g ON g.a = r.m),
k AS (SELECT n, min(m) AS class_id FROM r GROUP BY n)
SELECT d.doc_id, coalesce(k.class_id, d.doc_id) AS class_id FROM d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN u ON u.ss = s.ss LEFT JOIN k ON k.n = u.doc_id
"""


_CUT = r"regexp_extract_all(lower(coalesce({}, '')), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
_FIVE = "list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' '))"

#: Items of five words and more; the driver's tables have no shorter ones, which tests cover.
OP7_SQL = f"""
WITH i AS (SELECT item_id, {_FIVE} AS ss FROM (SELECT item_id, {_CUT.format('text')} AS w FROM benchmark) WHERE len(w) >= 5),
c AS (SELECT item_id, x, count(*) AS n FROM (SELECT item_id, unnest(ss) AS x FROM i) GROUP BY ALL),
d AS (SELECT doc_id, {_FIVE} AS ss FROM (SELECT doc_id, {_CUT.format('text')} AS w FROM documents) WHERE len(w) >= 5),
p AS (SELECT doc_id, unnest(range(len(ss))) AS k, unnest(ss) AS x FROM d),
h AS (SELECT doc_id, item_id, k, x, n FROM p JOIN c USING (x)),
v AS (SELECT doc_id, item_id, len(i.ss) AS size, least(len(i.ss), len(d.ss)) AS width, unnest(range(greatest(1, len(d.ss) - len(i.ss) + 1))) AS start FROM (SELECT DISTINCT doc_id, item_id FROM h) JOIN d USING (doc_id) JOIN i USING (item_id)),
m AS (SELECT doc_id, item_id, start, size, width, x, least(count(*), n) AS shared FROM v JOIN h USING (doc_id, item_id) WHERE k >= start AND k < start + width GROUP BY doc_id, item_id, start, size, width, x, n),
s AS (SELECT doc_id, item_id, start, CAST(sum(shared) AS DOUBLE) / CAST(size + width - sum(shared) AS DOUBLE) AS similarity FROM m GROUP BY doc_id, item_id, start, size, width)
SELECT doc_id, item_id, similarity, start AS start_word FROM s WHERE similarity >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""


def _license_sql() -> str:
    from .license_scan import TEMPLATES

    rows = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in TEMPLATES.items())
    return f"""
WITH i AS (SELECT license, list_distinct({_FIVE}) AS ss FROM (SELECT license, {_CUT.format('text')} AS w FROM (VALUES {rows}) v(license, text)) WHERE len(w) >= 5),
c AS (SELECT license, unnest(ss) AS x, len(ss) AS size FROM i),
d AS (SELECT doc_id, {_FIVE} AS ss FROM (SELECT doc_id, {_CUT.format('text')} AS w FROM documents) WHERE len(w) >= 5),
p AS (SELECT doc_id, unnest(range(len(ss))) AS k, unnest(ss) AS x FROM d),
h AS (SELECT doc_id, license, k, x, size FROM p JOIN c USING (x)),
f AS (SELECT doc_id, license, count(DISTINCT x) AS kinds, CAST(count(DISTINCT x) AS DOUBLE) / any_value(size) AS containment FROM h GROUP BY ALL HAVING count(DISTINCT x) >= 0.8 * any_value(size)),
a AS (SELECT h.doc_id, license, h.k AS first, g.x, min(g.k) AS k FROM h JOIN f USING (doc_id, license) JOIN h g USING (doc_id, license) WHERE g.k >= h.k GROUP BY ALL),
e AS (SELECT doc_id, license, first, max(k) AS last, count(*) AS kinds FROM a GROUP BY ALL)
SELECT doc_id, license, containment, first AS start_word FROM e JOIN f USING (doc_id, license, kinds) QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY last - first, first) = 1
"""


def _runs_sql(levels: int = 16) -> str:
    """Runs of period q as islands: the windows of 2**k words with 2**(k - 1) < q <= 2**k next recur after exactly q words. Texts of up to 2**(levels + 1) words."""
    hashes = "l0 AS (SELECT doc_id, i, hash(word) AS h FROM p)"
    for k in range(1, levels):
        half = 1 << (k - 1)
        hashes += f",\nl{k} AS (SELECT doc_id, i, hash(h, m) AS h FROM (SELECT doc_id, i, h, lead(h, {half}) OVER (PARTITION BY doc_id ORDER BY i) AS m FROM l{k - 1}) WHERE m IS NOT NULL)"
    lags = " UNION ALL ".join(
        f"SELECT doc_id, i, {1 << k} AS size, d FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id, h ORDER BY i) - i AS d FROM l{k}) WHERE d <= {1 << k} AND 2 * d > {1 << k}" for k in range(levels)
    )
    return rf"""
WITH b AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  xor(list_reduce(flatten(list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i: list_concat([CAST(ascii(CAST(doc_id AS VARCHAR)[i + 1]) AS BIGINT)], list_transform(range(8), lambda j: CAST(-1 AS BIGINT))))),
    lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, CASE WHEN acc & 1 = 1 THEN 3988292384 ELSE 0 END) END, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS h FROM documents),
a AS (SELECT doc_id, w, h, CAST(len(w) AS BIGINT) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM b),
d AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END) + 1]) ELSE w END AS w FROM a),
p AS MATERIALIZED (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word FROM d),
{hashes},
g AS ({lags}),
e AS (SELECT doc_id, i, size, d, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM g),
r AS MATERIALIZED (SELECT doc_id, CAST(min(i) AS BIGINT) AS start, CAST(count(*) + d + any_value(size) - 1 AS BIGINT) AS length, CAST(d AS BIGINT) AS period FROM e GROUP BY doc_id, d, island HAVING count(*) + d + any_value(size) - 1 >= greatest(6, 4 * d)),
t AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines, first(start ORDER BY length DESC, start, period) AS start, first(length ORDER BY length DESC, start, period) AS length, first(period ORDER BY length DESC, start, period) AS period FROM r GROUP BY doc_id),
x AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM p ANTI JOIN x USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of the documents that all stages keep."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_secret_scan": op2_secret_scan,
        "op3_html_text": op3_html_text,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_warc": op5_warc,
        "op6_license_scan": op6_license_scan,
        "op7_decontaminate": op7_decontaminate,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_near_dedup": op9_near_dedup,
        "op10_quality_rules": op10_quality_rules,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_first_fit_packing": op12_first_fit_packing,
        "op13_embedding_whitening": op13_embedding_whitening,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_secret_scan": _secret_sql(), "op5_warc": OP5_SQL, "op8_substring_dedup": OP8_SQL, "op9_near_dedup": OP9_SQL, "op7_decontaminate": OP7_SQL, "op6_license_scan": _license_sql(), "op11_periodic_runs": _runs_sql()}
