"""Token counts of whole texts by overlap resynchronisation.

A text is encoded as overlapping chunks with offsets. Two neighbouring chunks are spliced at a boundary that is proven
stable: it follows ASCII white space, both encodings have a token border there, and the tokens around it are the same in
both. White space is never part of a token of a tokenizer that drops it, so the runs on either side of such a border do not
influence each other. Where no such border lies in the overlap, the overlap is widened, if need be over the rest of the text.
At most two chunks' encodings are held at a time.

A text of a single chunk needs no splice; its white-space-delimited runs are counted through a bounded memo of runs, each
encoded by the library. That the tokenizer drops white space, on which both rest, is read from its own definition when it is
loaded: its words must come from a pattern of known parts that match no white space. Texts are encoded whole with any other.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import trimmed

#: Runs that a worker remembers at most, and the longest run that it remembers.
MEMO_RUNS, MEMO_CHARS = 500_000, 64
_BLANK = frozenset(" \t\n\x0b\x0c\r")


@functools.lru_cache(maxsize=4)
def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: Parts of patterns that match no white space, pre-tokenizers that cut at it, normalizers that change no text beside it.
PARTS = frozenset({"'s", "'t", "'re", "'ve", "'m", "'ll", "'d", r"[\p{L}]+", r"[\p{N}]", r"[\p{N}]+", r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\w+", r"[^\w\s]+"})
CUTTERS, NORMALIZERS = frozenset({"Whitespace", "WhitespaceSplit", "BertPreTokenizer"}), frozenset({"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents"})


def _steps(found: dict | None, name: str) -> list[dict]:
    return [] if found is None else [y for x in found[name] for y in _steps(x, name)] if found["type"] == "Sequence" else [found]


@functools.lru_cache(maxsize=4)
def drops_blanks(path: str) -> bool:
    """Whether the tokenizer's definition shows that white space ends each word, is in none, and changes nothing beside it."""
    with open(path) as f:
        found = json.load(f)
    for x in _steps(found["normalizer"], "normalizers"):
        if x["type"] not in NORMALIZERS and not (x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " "):
            return False
    if any(x["lstrip"] or x["rstrip"] or x["single_word"] or _BLANK & set(x["content"]) for x in found["added_tokens"]):
        return False
    first = next(iter(_steps(found["pre_tokenizer"], "pretokenizers")), {"type": None})
    if first["type"] == "Split":
        return first["behavior"] == "Removed" and first["invert"] and set(first["pattern"].get("Regex", " ").split("|")) <= PARTS
    return first["type"] in CUTTERS


class Memo(dict):
    """Token counts of white-space-delimited runs."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, run: bytes) -> int:
        n = len(self.tokenizer.encode(run.decode(), add_special_tokens=False).ids)
        if len(run) <= MEMO_CHARS:
            if len(self) >= MEMO_RUNS:
                self.clear()
            self[run] = n
        return n


def encoded(tokenizer, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
    """(first character, last character + 1, id) of each token of ``text[start:end]``, in the text's positions."""
    found = tokenizer.encode(text[start:end], add_special_tokens=False)
    return [(a + start, b + start, i) for (a, b), i in zip(found.offsets, found.ids)]


def splice(text: str, left: list, right: list, low: int, high: int, agree: int) -> tuple[int, int] | None:
    """Indexes (in left, in right) of the token that starts at the middlemost stable border in [low, high], or None."""
    at_right = {t[0]: j for j, t in reversed(list(enumerate(right))) if low <= t[0] <= high}
    middle, best = (low + high) / 2, None
    for i, t in enumerate(left):
        j = at_right.get(t[0])
        if j is None or not low < t[0] <= high or text[t[0] - 1] not in _BLANK:
            continue
        if i < agree or j < agree or left[i - agree : i] != right[j - agree : j] or left[i : i + agree] != right[j : j + agree] or len(left) - i < agree:
            continue
        if best is None or abs(t[0] - middle) < abs(left[best[0]][0] - middle):
            best = (i, j)
    return best


def spliced(tokenizer, text: str, chunk: int, overlap: int, agree: int = 2) -> Iterator[list[tuple[int, int, int]]]:
    """The tokens of ``text`` in order, as lists, from overlapping chunks of ``chunk`` characters."""
    border, end = 0, min(len(text), chunk)
    left = encoded(tokenizer, text, border, end)
    while end < len(text):
        found, wide = None, overlap
        while found is None:
            begin = max(border, end - wide)
            stop = min(len(text), end + max(chunk - overlap, end - border if begin == border else 0))
            right = encoded(tokenizer, text, begin, stop)
            if begin == border:  # no stable border since the last one: the chunk itself grows, twofold each time
                break
            found = splice(text, left, right, begin, end, agree)
            wide *= 2
        if found is None:
            left = right
        else:
            yield left[: found[0]]
            left = right[found[1] :]
            border = left[0][0]
        end = stop
    yield left


def counter(path: str, chunk: int, overlap: int) -> Callable[[str], int]:
    tokenizer = load(path)
    if not drops_blanks(path):
        return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
    memo = Memo(tokenizer)

    def count(text: str) -> int:
        if len(text) <= chunk:
            return sum(map(memo.__getitem__, text.encode().split()))
        return sum(map(len, spliced(tokenizer, text, chunk, overlap)))

    return count


def token_counts(docs: DataFrame, tokenizer_path: str, chunk: int = 16_384, overlap: int = 512, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row of ``docs`` (doc_id, text); see the module's text."""

    def run(batches):
        count = counter(tokenizer_path, chunk, overlap)
        for batch in batches:
            n = [0 if not t else count(t) for t in (x.as_py() for x in batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(trimmed(run), f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
