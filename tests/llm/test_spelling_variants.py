"""op13: pivotal-gram candidates against a comparison of all word pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from marquee.llm import spelling_variants as SV

CLASHES = "doc_id long, text string, word string, n int, form string, root string"


def edited(a, b):
    """True if b is a with exactly one code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = (a, b) if len(a) < len(b) else (b, a)
    return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 199 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if edited(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    stems = ["colour", "organise", "theatre", "grammar", "accommodate", "rhythm", "millennium", "cafetería", "naïveté", "straße"]
    vocab = []
    for s in stems:
        vocab.append(s)
        for _ in range(4):
            i = rng.randrange(len(s))
            op = rng.choice("idr")
            c = rng.choice("aeioulnrstéè")
            vocab.append(s[:i] + c + s[i:] if op == "i" else s[:i] + s[i + 1:] if op == "d" else s[:i] + c + s[i + 1:])
    vocab += ["bababa", "bababab", "abababa", "aaaaaa", "aaaaaaa", "aaaaab", "abcabc", "abcabd", "ÀÉÎÕÜ×ÿ", "àéîõü×ÿ"]
    out = []
    for i in range(400):
        words = [rng.choice(vocab) if rng.random() < 0.7 else rng.choice(stems) for _ in range(rng.randrange(0, 40))]
        text = " ".join(w.upper() if rng.random() < 0.1 else w for w in words)
        out.append((i, text))
    out += [(400, None), (401, ""), (402, "colour " * 5000), (403, "x" * 3000), (None, "colour colour"), (404, "colour colour")]
    return out


def test_variants_equal_all_pairs(spark, rows):
    docs = spark.createDataFrame([(i, t, "w", 1, "f", "r") for i, t in rows], CLASHES).repartition(4)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in SV.variants(docs).collect()}
    assert got == brute(rows)
    assert any(v[0] for v in got.values()) and any(v[3] > 1 for v in got.values())


def test_pivots_disjoint_and_least():
    grams = [(5, 3, 0), (1, 1, 1), (2, 2, 2)]
    chosen = SV.pivots(grams)
    assert sorted(t[2] for t in chosen) == [0, 2]
    assert SV.pivots([(1, 1, 0), (9, 3, 4), (2, 2, 1)]) == [(1, 1, 0), (9, 3, 4)]


def test_variants_empty(spark):
    assert SV.variants(spark.createDataFrame([], CLASHES)).count() == 0


def test_words_alike_in_a_bigram_only_are_no_candidates(spark):
    """Words of one length with the same rare bigram at the same place inside, and one near pair."""
    rng = random.Random(5)
    half = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    words = sorted({f"{half()}{g}{half()}" for g in ("zq", "qz", "zx", "xz", "yz") for _ in range(40)}) + ["straxqgen", "straxqgem"]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    sig = SV.signatures(table, SV.gram_order(table)).collect()
    alike = {tuple(sorted((v.word, x.word))) for v in sig for x in sig if v.kind == "v" and x.kind == "x" and v.g == x.g and abs(v.p - x.p) <= 1 and abs(v.len - x.len) <= 1 and v.word != x.word}
    got = {tuple(sorted(r)) for r in SV.candidates(spark.createDataFrame(sig)).collect()}
    near = {(v, w) for i, v in enumerate(sorted(words)) for w in sorted(words)[i + 1:] if edited(v, w)}
    assert near <= got <= alike and len(near) >= 1 and 2 * len(got) < len(alike)


def test_no_word_table_is_broadcast(spark):
    """Explode hides how many rows the signatures become; as compact files they look small at any size."""
    words = spark.createDataFrame([("lettered",), ("letterad",)], "word string")
    plans = [SV.candidates(SV.signatures(words, SV.gram_order(words))), SV.variants(spark.createDataFrame([(1, "lettered " * 6 + "letterad " * 30)], "doc_id long, text string"))]
    for plan in plans:
        assert plan.count() == 2
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Broadcast" not in text, text
