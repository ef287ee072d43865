"""Every query of the library against its SQL, run by DuckDB over the same files."""

import hashlib
import json
import math
import os
import re

import pytest

from docloom.functions.text import drop_guid_lines
from docloom.plans.convert import text_pipeline
from docloom.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert got == want and got


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


@needs_data
def test_empty_tables(spark, tmp_path):
    for t in TABLES:
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for name in ("clean_markdown", "dedupe_stats", "dedupe_refs", "split_images", "ocr_group_rows", "hamming_pairs", "section_assemble", "pages_to_markdown"):
        assert QUERIES[name](spark, f"file://{tmp_path}").count() == 0, name


@needs_data
def test_titles_equal_sql(spark, duck, tmp_path):
    """References and white space that the given pages of sf0.001 do not have in their titles."""
    titles = ["a = &quot;x", "a &amp", "a &am", "a &amp;&amp;b &lt;", "&amp;quot;", "&amp;amp;", "&#65;&nbsp;", "&nbsp;", " \t\r\n\f&amp; b \n", "\x0b a \x0b", "\u00a0a\u2003", " \u00a0 ", " a\n b ", "", " ", None]
    rows = [(i, None if t is None else f"<TITLE lang=en>{t}</Title><title>z</title>") for i, t in enumerate(titles)]
    spark.createDataFrame([*rows, (100, "none"), (101, "<title>open &quot;")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    want = duck.execute(f"WITH pages AS (SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')) {ORACLE_SQL['page_title']}").fetchall()
    assert sorted(map(tuple, QUERIES["page_title"](spark, str(tmp_path)).collect())) == sorted(want)


@needs_data
def test_image_queries_take_whole_texts(spark):
    """Against brute force: whole texts as contents of images and below them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found, split, named, maps = set(), {}, {}, {}
    for d in docs:
        stem, bad = f"d{d.doc_id % 50}", "![bad](data:image/png;base64,AAA)" if d.doc_id % 5 == 0 else ""
        images = [(f"{d.lang} x", "jpg", d.text)] + ([("Image", "png", d.source)] if d.doc_id % 2 == 0 else [])
        sha = [hashlib.sha256(c.encode()).hexdigest() for _, _, c in images]
        files = [f"image_00{i}_{hashlib.md5(c.encode()).hexdigest()[:8]}.{e}" for i, (_, e, c) in enumerate(images, 1)]
        found |= {(d.doc_id, i, a, f, h) for i, ((a, _, _), f, h) in enumerate(zip(images, files, sha), 1)}

        def md(names):
            refs = [f"![{a}]({stem}.images/{n})" for (a, _, _), n in zip(images, names)] + [""]
            return f"a {bad} b {refs[0]}\n{refs[1]}\n{d.text}"

        split[d.doc_id], named[d.doc_id] = md(files), md([f"{h[:16]}.{e}" for h, (_, e, _) in zip(sha, images)])
        maps[d.doc_id] = [(i, f, h) for i, (f, h) in enumerate(zip(files, sha), 1)]
    of = lambda name: QUERIES[name](spark, SF)
    assert max(len(d.text) for d in docs) > 10000
    assert {(r.doc_id, r.occurrence, r.alt, r.original_file, r.sha256) for r in of("image_occurrence").collect()} == found
    assert {r.doc_id: r.md for r in of("split_images").collect()} == split
    assert {r.doc_id: [(e["occurrence"], e["final_file"], e["content_sha256"]) for e in json.loads(r.image_map)["entries"]] for r in of("image_map_json").collect()} == maps
    rows = lambda x: spark.createDataFrame(list(x.items()), "doc_id long, md string").withColumn("md", drop_guid_lines("md"))
    assert {r.doc_id: r.md for r in of("postprocess_refs").collect()} == {r.doc_id: r.md for r in rows(split).collect()}
    assert {r.doc_id: r.md for r in of("convert_documents").collect()} == {r.doc_id: r.md for r in text_pipeline(rows(named)).collect()}


@needs_data
def test_latex_queries_take_whole_texts(spark):
    """Against brute force over tokens, over whole texts."""
    despaced, thin = {}, {}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        f = f"R _ {{ {d.lang} }} = \\mu A \\max  off \\, 1\\,2\\,3 \\, \\x\n y\t{d.text}" + "\\" * (d.doc_id % 4 == 0)
        t = re.findall(r"\\[A-Za-z]+|\\.|\s+|[^\\\s]", f)
        blank = lambda k: " " * bool(re.fullmatch(r"\\[A-Za-z]+", t[k - 1]) and k + 1 < len(t) and t[k + 1][0].isalpha())
        despaced[d.doc_id] = "".join(blank(k) if x.isspace() else x for k, x in enumerate(t))
        thin[d.doc_id] = re.sub(r"(?<=\d)\\,(?=\d)", "", f)
    assert max(map(len, thin.values())) > 10000
    assert {r.doc_id: r.latex for r in QUERIES["latex_despace"](spark, SF).collect()} == despaced
    assert {r.doc_id: r.latex for r in QUERIES["latex_thinspace"](spark, SF).collect()} == thin
