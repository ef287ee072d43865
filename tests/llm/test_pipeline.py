import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from docloom.llm.common import cut

from .test_jaccard_join import sets
from .test_quality import verdicts


def test_stages_against_brute_force(spark, tmp_path):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    rows = []
    for i in range(260):
        w = [word() for _ in range(r.randint(5, 120))]
        if i % 4 == 1:
            w[len(w) // 2] = "numskull"
        text = " ".join(w) + ("\nsubscribe to our news letter now" if r.random() < 0.2 else "")
        rows.append((i, text, "en", f"s{i % 3}"))
    rows += [(300 + i, rows[2 * i][1] + " more", "en", rows[2 * i][3]) for i in range(20)] + [(400, None, "en", None), (401, "", None, "s1")]
    docs = spark.createDataFrame([(d, t, x, s, len(t or "")) for d, t, x, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(d, 1, int("numskull" in (t or ""))) for d, t, *_ in rows], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    sf, at = f"file://{tmp_path}", docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = cut(stage(spark, at, sf), "t")
        assert at.columns == docs.columns
        kept[name] = {x.doc_id: x.text for x in at.collect()}
        kept[name, "rows"] = at.count()
    want = {v[0]: t for v, t in verdicts([(d, s, t) for d, t, _, s in rows]) if v[-1]}
    assert kept["quality rules"] == want
    clean = {d: t for d, t in want.items() if "numskull" not in t}
    got = kept["toxicity"]
    assert set(got) <= set(want) and len(set(got) ^ set(clean)) <= 0.05 * len(clean)
    single = kept["n-gram Jaccard join"]
    for d in got:
        near = [e for e in got if 100 * len(sets(got[d], 5) & sets(got[e], 5)) >= 80 * len(sets(got[d], 5) | sets(got[e], 5))]
        assert (d in single) == (d == min(near))
    words = sum(len(t.split()) for t in single.values())
    mix = [x.text for x in at.collect()]
    assert abs(sum(len(t.split()) for t in mix) - 1.5 * words) <= 3
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    digests = sorted(hashlib.sha256(",".join(map(str, t.encode(x).ids)).encode()).hexdigest() for x in mix)
    assert sorted(x.ids_sha256 for x in corpus_pipeline.bpe_stage(spark, at, sf).collect()) == digests
    assert len(corpus_pipeline.run(spark, sf).collect()) == len(mix)


def test_empty_documents_and_clashing_columns(spark, tmp_path):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    rows = [(i, " ".join([*(word() for _ in range(40)), *(["numskull"] if i % 4 == 1 else [])]), f"s{i % 2}" if i % 5 else None, -1, "n", 2, "x") for i in range(60)]
    rows += [(None, rows[0][1], "s0", -1, "n", 2, "x"), (None, None, None, None, None, None, None), (5, rows[5][1], None, 0, "m", 1, "y"), (6, "long " + " ".join(word() for _ in range(30000)), "s1", 0, "m", 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __size int, __node string, __host int, component string")
    labels = spark.createDataFrame([(d, int("numskull" in t)) for d, t, *_ in rows if d is not None], "doc_id long, toxic int")
    for name, table in (("full", docs), ("empty", docs.limit(0))):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    at = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = cut(stage(spark, at, f"file://{tmp_path}/full"), "t")
        assert at.columns == docs.columns
        kept = at.collect()
        assert kept and all((x["__size"], x["__node"], x["__host"], x.component) in ((-1, "n", 2, "x"), (0, "m", 1, "y")) for x in kept)
    assert corpus_pipeline.run(spark, f"file://{tmp_path}/empty").collect() == []
