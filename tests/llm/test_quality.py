import random
import re
from collections import Counter

from docloom.llm.quality import cleaned, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    g = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(g)
    covered = {j for i, x in enumerate(g) if n[x] >= 2 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))


def norm(x):
    return re.sub(r"[\x20\x09-\x0D]+", " ", x.lower()).strip(" ")


def verdicts(rows, min_docs=5, share=0.02):
    host = {}
    for _, s, t in rows:
        host.setdefault(s, set()).add(t or "")
    often = {}
    for s, texts in host.items():
        c = Counter(x for t in texts for x in {norm(x) for x in t.split("\n") if WORD.search(x)})
        often[s] = {x for x, n in c.items() if n > min_docs and n > share * len(texts)}
    out = []
    for i, s, t in rows:
        b = base(t)
        left = [x for x in (t or "").split("\n") if norm(x) not in often[s] or not WORD.search(x)]
        removed = len([x for x in (t or "").split("\n") if WORD.search(x) and norm(x) in often[s]])
        n = b[0] - sum(len(WORD.findall(x)) for x in (t or "").split("\n") if norm(x) in often[s])
        kept = not b[5] and not (removed and (n < 10 or n < 0.3 * b[0]))
        out.append(((i, *b, n, kept), "\n".join(left) if removed else t))
    return out


def data():
    r = random.Random(2)
    vocabulary = ["alpha", "béta", "gam#ma", "$", "|x|", "delta", "ε", "zeta", "eta", "theta"]
    rows = []
    for i in range(300):
        parts = [" ".join(r.choice(vocabulary) + str(r.randint(0, 30)) for _ in range(r.randint(0, 25))) for _ in range(r.randint(0, 5))]
        if r.random() < 0.3:
            parts.insert(0, r.choice(["Read  MORE here now", "read more\there now "]))
        if r.random() < 0.2:
            parts += parts[:1] * 2
        rows.append((i, r.choice(["a", "b", None]), r.choice(["\n", "\n\n", "\r\n"]).join(parts)))
    rows += [(400 + i, "a", rows[3][2]) for i in range(40)] + [(500, "a", None), (501, "a", ""), (501, "a", ""), (None, "c", "one two three four five six seven eight nine ten"), (502, "c", "x y " * 3000), (503, "c", "a b c d e f g h i j k")]
    return rows


def test_against_brute_force(spark):
    rows = data()
    df = spark.createDataFrame([(*x, 5, "k") for x in rows], "doc_id long, source string, text string, n_words int, kept string")
    want = verdicts(rows)
    got = [tuple(r) for r in quality(df).collect()]
    assert sorted(got, key=str) == sorted((w for w, _ in want), key=str)
    kept = [(w[0], t) for w, t in want if w[-1]]
    assert sorted(((r.doc_id, r.text) for r in cleaned(df).collect()), key=str) == sorted(kept, key=str)
    assert any(t is not None and w[7] != w[1] for w, t in want if w[-1])
    assert quality(df.limit(0)).count() == 0 and cleaned(df).columns == df.columns
