"""WARC, URL filter, top-k, near-dedup and the pipeline: brute force, SQL, odd inputs."""

import base64
import hashlib
import io
import os
import random
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rasterloom.llm import decontaminate, language, near_dedup, registry, topk, url_cascade, warc
from rasterloom.operators.components import connected_components
from rasterloom.session import shared_path, table
from tests.conftest import SF
from tests.oracle import connect, same


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", ["op4_warc", "op5_url_filter", "op7_top_k"])
def test_query_equals_sql(spark, duck, name):
    same(registry.queries()[name](spark, SF), duck, registry.oracle_sql()[name])


PAGES = [
    (1, "http://a/ b\r\nX: y", "<p>same</p>", "x"), (5, "http://b/é", "<p>same</p>", "x"), (5, "http://b/é", "<p>same</p>", "x"), (2, None, None, "x"), (3, "", "", "x"),
    (None, "http://n", "<p>null id</p>", "x"), (None, "http://n", "<p>same</p>", "x"), (9, "http://long", "<b>" + "long " * 200_000, "x"), (10, "http://q", "ü漢\0\r\n\r\nWARC/1.1", "x"),
]


def test_warc_of_odd_rows(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string, digest string")
    rows = warc.read_archives(spark, warc.write_archives(df)).collect()
    assert len(rows) == len(PAGES)
    want = sorted((p, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()) for p, _, h, _ in PAGES if p is not None)
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest) for r in rows if r.page_id is not None) == want
    of_same = [r for r in rows if r.payload_bytes == len("<p>same</p>")]
    assert sorted((r.record_type, r.refers_to) for r in of_same) == [("response", None)] + [("revisit", 5)] * 3
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in rows if r.payload_bytes == 0) == [(2, "revisit", 3), (3, "response", None)]
    assert all("\r" not in (r.uri or "") and " " not in (r.uri or "") for r in rows)
    assert warc.write_archives(df.limit(0)) == [] and warc.read_archives(spark, []).count() == 0


def test_small_payloads_may_stay_apart(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    rows = warc.read_archives(spark, warc.write_archives(df, min_payload=3)).collect()
    assert sorted((r.page_id, r.record_type) for r in rows) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_archives_begin_with_their_dictionary(spark):
    paths = warc.write_archives(table(spark, SF, "pages"))
    raw = open(paths[0].removeprefix("file://"), "rb").read()
    assert int.from_bytes(raw[:4], "little") == warc.SKIPPABLE and int.from_bytes(raw[4:8], "little") > 1000
    with pytest.raises(Exception):
        list(warc.read_archive(io.BytesIO(raw[:-10])))
    assert [warc.parse_record(r)[0]["WARC-Type"] for r in warc.read_archive(io.BytesIO(raw), chunk=97)]


URLS = [
    (1, "HTTP://Sub.Example.ORG/es/x?q", "k"), (2, None, "k"), (3, "no scheme", "k"), (4, "x://", "k"), (5, "a://b://c/d", "k"), (6, "http://com/fr/", "k"), (7, "http://xcom/fr/", "k"),
    (8, "http://a.com?x=/fr/", "k"), (9, "http://É.com/de/#x", "k"), (9, "http://É.com/de/#x", "k"), (None, "http://h\n/p\n", "k"), (11, "http://example.org/en/1", "k"),
]


def test_urls_of_odd_rows(spark):
    df = spark.createDataFrame(URLS, "page_id long, url string, host string")
    rows = {r.page_id: r for r in url_cascade.judge(df, F.col("host").isin("b:", "xcom", ""), registry.RULES).collect()}
    assert (rows[1].host, rows[1].path, rows[1].rule, rows[1].verdict) == ("sub.example.org", "/es/x", "example.org/es/", "block")
    assert (rows[2].host, rows[2].path, rows[2].rule, rows[2].verdict) == ("", "", None, "block")
    assert (rows[3].host, rows[4].host, rows[4].path) == ("", "", "")
    assert (rows[5].host, rows[5].path, rows[5].verdict) == ("b:", "//c/d", "block")
    assert rows[6].rule == "com/fr/" and rows[7].rule is None and rows[7].verdict == "block"
    assert (rows[8].path, rows[8].rule, rows[8].verdict) == ("", None, "allow")
    assert rows[9].host == "É.com" and rows[9].rule == "com/de/"
    assert (rows[None].host, rows[None].path) == ("h\n", "/p\n") and rows[11].rule == "example.org/en/1"
    assert url_cascade.judge(df, F.lit(True), registry.RULES).count() == len(URLS)
    assert url_cascade.judge(df.limit(0), F.lit(True), registry.RULES).count() == 0


def test_cascade_is_exact(spark, monkeypatch):
    monkeypatch.setattr(url_cascade, "KEYS_A_WORD", 20)  # many false positives, so several levels
    keys = spark.range(5000).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % 7 < 2).alias("listed"))
    cascade = url_cascade.build_cascade(keys)
    assert len(cascade.levels) > 2
    assert keys.where(cascade.contains(F.col("key")) != F.col("listed")).count() == 0
    with pytest.raises(ValueError):
        url_cascade.build_cascade(keys, max_bytes=64)


def test_one_foreign_key_in_a_hundred_passes_a_level(spark):
    keys = spark.range(20000).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") < 4000).alias("listed"))
    (first, *_) = url_cascade.build_cascade(keys).levels
    passed = keys.where("not listed").where(first.passes(F.col("key"))).count()
    assert passed < 16000 / 100 and first.n_words == 1000


def test_no_filter_stands_in_the_plan(spark):
    """A plan for 20,000 listed hosts is no longer than one for a few, and the filter is read once a level."""
    sizes = []
    for n in (10, 20_000):
        pages = spark.range(2 * n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), "id", F.lit(".net/p")).alias("url"))
        listed = spark.range(n).select(F.concat(F.lit("h"), "id", F.lit(".net")).alias("host"))
        judged = url_cascade.judge(pages, listed, registry.RULES)
        sizes.append(len(judged._jdf.queryExecution().toString()))
        assert judged.where("verdict = 'block'").count() == n
    assert sizes[1] < 3 * sizes[0]


def test_block_lists_may_be_tables(spark):
    df = spark.createDataFrame(URLS, "page_id long, url string, host string")
    listed = spark.createDataFrame([("xcom",), ("xcom",), (None,), ("nowhere",), ("",)], "host string")
    as_table = url_cascade.judge(df, listed, registry.RULES).collect()
    as_predicate = url_cascade.judge(df, F.col("host").isin("xcom", "nowhere", ""), registry.RULES).collect()
    assert sorted(map(str, as_table)) == sorted(map(str, as_predicate)) and any(r.verdict == "block" for r in as_table)
    assert {r.verdict for r in url_cascade.judge(df, listed.limit(0), []).collect()} == {"allow"}


def test_long_urls_are_read_whole(spark):
    long = "http://Long.ORG/" + "a/" * 500_000 + "end?q"
    (row,) = url_cascade.judge(spark.createDataFrame([(1, long)], "page_id long, url string"), F.lit(False), registry.RULES).collect()
    assert (row.host, row.path) == ("long.org", long[15:-2]) and row.rule == "org/"


def test_long_lists_are_judged_in_parts(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 1500, F.lit(".net/p")).alias("url"))
    listed = F.substring(F.md5(F.col("host").cast("binary")), 1, 1).isin("0", "1", "2", "3")
    assert url_cascade.parts_needed(375, 1125, 400) > 1
    rows = url_cascade.judge(pages, listed, registry.RULES, max_bytes=400).collect()
    assert len(rows) == 3000 and all((r.verdict == "block") == (hashlib.md5(r.host.encode()).hexdigest()[0] in "0123") for r in rows)


def brute_top(vectors, queries, k):
    out = []
    for q, vector in queries:
        scores = sorted((-sum(a * b for a, b in zip(vector, v, strict=True)), i) for i, v in vectors if i != q and len(v) == len(vector))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("rows,width,largest,k", [(700, 5, 50, 10), (300, 3, 1, 7), (40, 2, 10**9, 3), (5, 4, 9, 10)])
def test_top_k_equals_brute_force(spark, monkeypatch, rows, width, largest, k):
    """Ties, vectors of other lengths, and query rows that share an id with equal and different vectors."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    rng = random.Random(rows)
    vectors = [(i, [rng.randrange(-largest, largest + 1) for _ in range(width)]) for i in range(rows)]
    vectors += [(rows + 1, vectors[0][1]), (rows + 2, [1]), (0, vectors[0][1]), (0, vectors[3][1]), (7007, []), (14014, []), (21, [0] * width)]
    df = spark.createDataFrame(vectors, "vec_id long, vector array<bigint>")
    queries = [(i, v) for i, v in vectors if i % 7 == 0]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id % 7 = 0"), k).collect()]
    assert sorted(got) == brute_top(vectors, queries, k)


def test_top_k_sql_with_repeated_query_ids(spark, tmp_path, duck):
    import duckdb

    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in [*range(300), 100, 100, 200]]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    found = registry.op7_top_k(spark, str(tmp_path))
    assert found.where("query_id = 100").count() == 30
    same(found, con, registry.oracle_sql()["op7_top_k"])


def test_reading_stops_early_where_few_rows_stand_out():
    """Rows of very different lengths: the longest come first in all lists."""
    rng = np.random.default_rng(0)
    norms = 50 * rng.pareto(1.0, size=(4000, 1)) + 1
    rows = np.floor(norms * rng.uniform(0.9, 1.1, size=(4000, 16)) * rng.choice([-1, 1], size=16))
    best, ids = topk.Best(5, 10), np.arange(4000)
    read = topk.search_lists(topk.sorted_lists(ids, rows), rows[:5], ids[:5], best)
    assert (read < 0.3 * rows.size).all()
    for q in range(5):
        scores = rows @ rows[q]
        scores[q] = -np.inf
        want = sorted(zip(-scores, ids, strict=True))[:10]
        assert [(int(-s), int(i)) for s, i in want] == list(zip(best.scores[q].tolist(), best.ids[q].tolist(), strict=True))


def test_only_entries_that_count_as_read_matter():
    """Entries beyond those that were counted may hold any smaller values: nothing is looked up by row."""
    rng = np.random.default_rng(4)
    rows = np.floor(rng.normal(size=(2000, 1)) * 1000)
    ids = np.arange(2000)
    lists = topk.sorted_lists(ids, rows)
    best, again = topk.Best(1, 10), topk.Best(1, 10)
    (entries,) = topk.search_lists(lists, np.array([[3.0]]), np.array([-1]), best)
    assert entries <= 250
    spoiled = topk.Lists(ids, lists.order, lists.values.copy())
    spoiled.values[0, entries:-1] = spoiled.values[0, -1]
    topk.search_lists(spoiled, np.array([[3.0]]), np.array([-1]), again)
    assert again.ids[0].tolist() == best.ids[0].tolist() and again.scores[0].tolist() == best.scores[0].tolist()


def test_a_component_outside_64_bits_is_an_error(spark):
    df = spark.createDataFrame([(0, [1e300])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk.integer_vectors(df).collect()


def test_vectors_of_odd_rows(spark):
    rows = [(0, [0.5, -0.25]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [0.1, 0.2]), (5, [0.1, 0.2]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    vectors = topk.integer_vectors(df)
    assert sorted((r.vec_id, r.vector) for r in vectors.collect()) == [(0, [512, -256]), (5, [102, 204]), (5, [102, 204]), (6, [])]
    got = topk.top_k(vectors, vectors.where("vec_id = 0")).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 5, 512 * 102 - 256 * 204), (2, 5, 512 * 102 - 256 * 204)]
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def brute_simhash(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aBé \t\n\x0b\u00a0\u2003İ", max_size=60))
def test_simhash_equals_definition(text):
    assert near_dedup.simhash(text) == brute_simhash(text)


def test_every_four_positions_hold_a_set():
    from itertools import combinations

    sets = near_dedup.position_sets()
    assert len(sets) == 20
    assert all(any(set(s) <= set(four) for s in sets) for four in combinations(range(8), 4))


def brute_groups(fps):
    from tests.test_operators import brute_components

    distinct = sorted(set(fps))
    edges = [(a, b) for i, a in enumerate(distinct) for b in distinct[i:] if (a ^ b).bit_count() <= 4]
    return brute_components(edges)


@pytest.mark.parametrize("dense", [True, False])
def test_links_connect_what_brute_force_connects(spark, dense):
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(3 if dense else 60)]
    fps = []
    for _ in range(400):
        x = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    fps += [0, (1 << 64) - 1, 1 << 63]
    df = spark.createDataFrame([(near_dedup._signed(f),) for f in set(fps)], "fp long")
    from rasterloom.operators.components import connected_components

    found = {r.node: r.root for r in connected_components(near_dedup.fingerprint_links(df), "a", "b").collect()}
    want = brute_groups(fps)
    groups = {}
    for f, root in want.items():
        groups.setdefault(root, set()).add(near_dedup._signed(f))
    for members in groups.values():
        assert len({found.get(m, m) for m in members}) == 1
    assert len({found.get(near_dedup._signed(f), near_dedup._signed(f)) for f in want}) == len(groups)


@pytest.mark.parametrize("batch", [7, 1000])
def test_long_lists_are_split_without_losing_links(spark, monkeypatch, batch):
    rng = random.Random(11)
    # One list of all: bytes 0 to 2 agree; a chain of near copies beside unrelated ones and pairs four bits apart in two bytes.
    fps = {0x123456 | rng.getrandbits(40) << 24 for _ in range(400)}
    fps |= {f ^ 0x0101 << 24 ^ 0x0101 << 40 for f in list(fps)[:60]} | {0x123456 | (2**k - 1) << 24 for k in range(0, 40, 3)}
    want = {f: f for f in fps}

    def root(f):
        while want[f] != f:
            f = want[f]
        return f

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                want[root(a)] = root(b)
    df = spark.createDataFrame([(near_dedup._signed(f),) for f in fps], "fp long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    monkeypatch.setattr(near_dedup, "SPLIT_RUN", 100)
    try:
        found = {r.node: r.root for r in connected_components(near_dedup.fingerprint_links(df), "a", "b").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by_root, by_want = {}, {}
    for f in fps:
        by_root.setdefault(found.get(near_dedup._signed(f), near_dedup._signed(f)), set()).add(f)
        by_want.setdefault(root(f), set()).add(f)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_want.values()))


def test_near_dedup_query_equals_brute_force(spark, duck):
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    fp = {d: brute_simhash(t) for d, t in docs}
    roots = brute_groups(fp.values())
    least = {}
    for d, f in fp.items():
        least[roots[f]] = min(least.get(roots[f], d), d)
    want = {d: (f"{f:016x}", least[roots[f]]) for d, f in fp.items()}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in registry.op10_near_dedup(spark, SF).collect()} == want


ODD = [(5, "one two three four five", 1), (4, "one two three four five", 1), (4, "one two three four five", 1), (None, "one two three four five", 1), (None, "alone here", 1), (7, None, 1), (8, "", 1), (9, " \n", 1), (6, "word " * 50_000, 1)]


def test_near_dedup_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, fp int")
    rows = near_dedup.components(df).collect()
    assert len(rows) == len(ODD)
    assert {(r.doc_id, r.component_id) for r in rows} == {(5, 4), (4, 4), (None, 4), (None, None), (7, 7), (8, 7), (9, 7), (6, 6)}
    assert {r.fingerprint for r in rows if r.doc_id in (7, 8, 9)} == {"0" * 16}
    kept = near_dedup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:5]) for r in kept.collect()) == [(False, 4, "one t"), (False, 6, "word "), (False, 7, ""), (True, 0, "alone")]
    assert near_dedup.components(df.limit(0)).count() == 0 and near_dedup.deduplicate(df.limit(0)).count() == 0


def test_a_missing_bitmap_is_an_error(spark, monkeypatch):
    df = spark.createDataFrame(ODD, "doc_id long, text string, fp int").repartition(3)
    folders = []
    monkeypatch.setattr(near_dedup, "shared_path", lambda s, name: folders.append(shared_path(s, name)) or folders[-1])
    kept = near_dedup.deduplicate(df)
    (folder,) = [f.removeprefix("file://") for f in folders if "kept-rows" in f]
    assert kept.count() == 4 and len(os.listdir(folder)) == 3
    os.remove(f"{folder}/{sorted(os.listdir(folder))[0]}")
    with pytest.raises(Exception):
        kept.count()


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontaminate", "packing"]
    known = corpus_pipeline.language_id(spark, docs, SF)
    told = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    assert known.columns == columns and {r.doc_id: r.lang for r in known.collect()} == {d: p for d, p in told.items() if p != "und"}
    single = corpus_pipeline.near_duplicates(spark, known, SF)
    groups = near_dedup.components(known)
    assert sorted(r.doc_id for r in single.collect()) == sorted(r.component_id for r in groups.select("component_id").distinct().collect())
    clean = corpus_pipeline.benchmark_leaks(spark, single, SF)
    leaks = {r.doc_id for r in decontaminate.find_leaks(single, table(spark, SF, "benchmark")).collect()}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - leaks
    texts = {r.doc_id: r.text for r in clean.collect()}
    got: dict[int, bytes] = {}
    for r in corpus_pipeline.run(spark, SF).orderBy("doc_id", "start").collect():
        assert r.length * 4 == len(r.ids) and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        got[r.doc_id] = got.get(r.doc_id, b"") + bytes(r.ids)
    library = Tokenizer.from_file(registry.WORD_BPE)
    assert got == {d: np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for d, t in texts.items()}


CLASHES = "doc_id long, text string, lang string, source string, n_chars int, fp long, row string, _row int, __rl_lang string, leaks int, ids binary"


@pytest.mark.parametrize("filled", [True, False])
def test_pipeline_of_odd_tables(spark, tmp_path, filled):
    """Nulls, repeats, a long text, columns with names that the stages use; and empty tables."""
    rows = [(None, None, None, None), (1, "", "en", "s"), (2, "hello there my friend of old", "en", "s"), (2, "hello there my friend of old", "en", "s"), (3, "x" * 100_000, None, None), (4, "say a leaked item here now", "en", "s")]
    rows = [(*r, 1, 7, "r", 8, "zz", 9, b"i") for r in rows] if filled else []
    spark.createDataFrame(rows, CLASHES).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, None), (2, "leaked item")] if filled else []
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == ({2, 3} if filled else set())
    docs = table(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        assert {(r.fp, r.row, r._row, r["__rl_lang"], r.leaks, bytes(r.ids)) for r in after.collect()} == ({(7, "r", 8, "zz", 9, b"i")} if filled else set())


def test_the_pipeline_leaves_only_its_result(spark):
    folder = shared_path(spark, "x").rsplit("/", 1)[0].removeprefix("file://")
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} == {"stage-packing"}


def test_dictionary_records_are_chosen_by_key(spark, monkeypatch):
    """No plan that sorts or limits rows carries a payload."""
    plans = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: plans.append(df._jdf.queryExecution().toString()) or collect(df))
    rows = table(spark, SF, "pages").select("page_id", F.monotonically_increasing_id().alias("row"), "url", F.col("html").cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    monkeypatch.setattr(warc, "SAMPLE_RECORDS", 20)
    found = warc._sampled(rows)
    assert len(found) == 20 and all(len(r[3]) <= warc.SAMPLE_BYTES for r in found)
    assert plans and not any("TakeOrdered" in p or "GlobalLimit" in p for p in plans)
    assert warc._sampled(rows.limit(0)) == []
