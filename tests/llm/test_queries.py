"""The registered queries on a small fixture: their columns, and their rows against their SQL."""

import random
import zlib

import duckdb
import pytest

from sightline.llm import registry
from sightline.llm.license_scan import TEMPLATES

WORDS = [f"{a}{b}" for a in ("ta", "le", "no", "shi", "Ka") for b in ("ri", "mo", "ka.", "n", "1")]
COLUMNS = {
    "op1_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op2_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op3_html_text": ["page_id", "url", "text", "n_chars"],
    "op4_best_fit_packing": ["bin_id", "doc_id", "piece", "start_word", "n_words"],
    "op5_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op6_license_scan": ["doc_id", "license", "containment", "start_word"],
    "op7_decontaminate": ["doc_id", "item_id", "similarity", "start_word"],
    "op8_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op9_near_dedup": ["doc_id", "class_id"],
    "op10_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"],
    "op11_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12_first_fit_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
}


def text(seed, n):
    r = random.Random(seed)
    return "".join(r.choice(WORDS) + r.choice([" ", " ", "\n", ", "]) for _ in range(n)).strip()


def edited(t, seed, n):
    r, w = random.Random(seed), t.split(" ")
    for _ in range(n):
        w[r.randrange(len(w))] = "edit"
    return " ".join(w)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    items = [(k, text(900 + k, 20 + 9 * k)) for k in range(4)]
    rows = [(k, text(k, 30 + 7 * k)) for k in range(30)]
    rows += [(100 + k, edited(text(k, 30 + 7 * k), k, 1)) for k in range(30)] + [(200 + k, text(k, 30 + 7 * k).upper()) for k in range(5)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one two"), (304, "One two."), (305, f"{text(1, 40)} {items[2][1]} {text(2, 50)}"), (306, text(77, 9000))]
    rows += [(310 + k, f"{text(k + 40, 25)} {t} {text(k + 60, 12)}") for k, t in enumerate(TEMPLATES.values())] + [(340, f"token = abc12345 {'0f' * 15} ₿ AKIA{'Z' * 20}")]
    pages = [(k, f"http://x/{k}", f"<html><body><article><p>{text(k % 7, 200)}</p></article></body></html>") for k in range(20)] + [(30, "u", None), (31, None, "")]
    frames = {
        "documents": spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame(items, "item_id long, text string"),
        "pages": spark.createDataFrame(pages, "page_id long, url string, html string"),
    }
    for name, frame in frames.items():
        frame.coalesce(2).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, tables, name):
    got = registry.queries()[name](spark, tables)
    assert got.columns == COLUMNS[name]
    rows = got.collect()
    n = {"documents": spark.read.parquet(f"{tables}/documents.parquet").count(), "pages": 22}
    if name not in ("op4_best_fit_packing", "op12_first_fit_packing", "op6_license_scan", "op7_decontaminate"):
        assert len(rows) == n["pages" if name in ("op3_html_text", "op5_warc") else "documents"]
    if name == "op1_quality_classifier":
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    if name == "op3_html_text":
        assert all(r.n_chars == len(r.text) for r in rows)
    sql = registry.oracle_sql().get(name)
    if sql:
        con = duckdb.connect()
        for t in ("documents", "labels", "benchmark", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
        want = con.execute(sql)
        order = [[d[0] for d in want.description].index(c) for c in COLUMNS[name]]
        assert sorted(map(tuple, rows), key=repr) == sorted((tuple(x[k] for k in order) for x in want.fetchall()), key=repr)
        assert rows


@pytest.fixture(scope="module")
def empty_tables(spark, tables, tmp_path_factory):
    folder = tmp_path_factory.mktemp("none")
    for name in ("documents", "labels", "benchmark", "pages"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", [*COLUMNS, "pipeline"])
def test_empty(spark, empty_tables, name):
    assert registry.queries()[name](spark, empty_tables).count() == 0


def test_pipeline_without_n_chars(spark, tables, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    docs.drop("n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    bins = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in bins.collect()} <= {r.doc_id for r in docs.collect()}


def test_packing_takes_the_tightest_free_bin():
    """Against a search over all bins, on random pieces with conflicts."""
    from sightline.llm.packing import pack_shard

    for seed in range(20):
        r = random.Random(seed)
        pieces = sorted(((r.randint(1, 60), r.choice([None, *range(6)]), r.choice([None, *range(9)])) for _ in range(150)), key=lambda p: -p[0])
        got = pack_shard(*(list(x) for x in zip(*pieces, strict=True)), 100)
        left, sources, clusters = [], [], []
        for (size, s, c), at in zip(pieces, got, strict=True):
            fit = [k for k in range(len(left)) if left[k] >= size and (left[k] > 0 or not size) and (s is None or s not in sources[k]) and (c is None or c not in clusters[k])]
            if at == len(left):
                assert not [k for k in fit if left[k] > 0]
                left.append(100)
                sources.append(set())
                clusters.append(set())
            else:
                assert at in fit and left[at] == min(left[k] for k in fit if left[k] > 0 or not size)
            left[at] -= size
            sources[at].add(s)
            clusters[at].add(c)
