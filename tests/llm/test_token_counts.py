import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docloom.llm.token_counts import drops_blanks, spliced, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts(seed):
    r = random.Random(seed)
    parts = ["the", "Straße", "éa", " ", "\n", "\t", "  ", " ", "<|endoftext|>", "12", "!!'s", "ǅ", "日本", "x" * 40, "don't", "́", "👍🏽", "\x85"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 400))) for _ in range(60)]


@pytest.mark.parametrize("chunk,overlap", [(40, 8), (200, 30), (64, 63)])
def test_splices_equal_whole_encoding(chunk, overlap):
    t = Tokenizer.from_file(PATH)
    for text in [*texts(chunk), "a" * 3000, "word " * 500, "x y" + "z" * 500 + " " + "q" * 700]:
        got = [x[2] for part in spliced(t, text, chunk, overlap) for x in part]
        assert got == t.encode(text, add_special_tokens=False).ids


def test_counts(spark):
    t = Tokenizer.from_file(PATH)
    rows = [(i, x, "y") for i, x in enumerate(texts(1))] + [(900, None, "y"), (901, "", "y"), (901, "", "y"), (None, "a b", "y"), (903, "long words " * 4000, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(df, PATH, chunk=500, overlap=40).collect()}
    for i, x, _ in rows:
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        assert got[i] == (len((x or "").encode()), n, n > 2048)
    assert token_counts(df.limit(0), PATH).count() == 0


def test_tokenizers_that_keep_white_space(spark):
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert drops_blanks(PATH) and not drops_blanks(other)
    t = Tokenizer.from_file(other)
    data = [(i, x) for i, x in enumerate(texts(2))] + [(99, "a  b \n\n c" * 300)]
    got = {r.doc_id: r.n_tokens for r in token_counts(spark.createDataFrame(data, "doc_id long, text string"), other, chunk=100, overlap=10).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in data}
