"""op8 on stretches of which very many documents share a part: every repeat of an earlier document is found."""

import random

from marquee.llm import sparse_suffixes


def prose(rng, n):
    return [rng.choice("ab") + str(rng.randrange(30000)) for _ in range(n)]


def test_repeat_round_a_phrase_of_many_documents(spark):
    """Documents share 48 words, every two of them also two words on either side: 52 words in a row."""
    rng = random.Random(8)
    phrase, texts = prose(rng, 48), []
    for _ in range(100):
        front, back = prose(rng, 2), prose(rng, 2)
        texts += [" ".join([*prose(rng, 40), *front, *phrase, *back, *prose(rng, 40)]) for _ in range(2)]
    rng.shuffle(texts)
    words = [t.split() for t in texts]
    first = {}
    for i, w in enumerate(words):
        first.setdefault(" ".join(w[40:92]), i)
    want = {(i, 40, 52, first[" ".join(w[40:92])], 40) for i, w in enumerate(words) if first[" ".join(w[40:92])] != i}
    assert len(want) == 100
    docs = spark.createDataFrame([*enumerate(texts), (500, None), (501, ""), (None, texts[0])], "doc_id long, text string")
    assert {tuple(r) for r in sparse_suffixes.repeats(docs).collect()} == want


def test_repeat_in_texts_of_one_word(spark):
    """The longer text has windows beyond the match on the first diagonal; each is covered, no row is given twice."""
    docs = spark.createDataFrame([(1, "no " * 60), (2, "no " * 400), (2, "no " * 400)], "doc_id long, text string")
    got = [tuple(r) for r in sparse_suffixes.repeats(docs).collect()]
    assert {w for _, start, n, _, _ in got for w in range(start, start + n)} == set(range(400))
    assert sparse_suffixes.repeats(docs).columns == ["doc_id", "start", "n_words", "other_id", "other_start"]


def test_texts_are_not_read_again_to_divide_suffixes(spark):
    """One read makes suffixes, one windows, and each of the two comparisons takes one."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rng = random.Random(3)
    shared = " ".join(prose(rng, 70))
    docs = spark.createDataFrame([(i, f"{' '.join(prose(rng, 30))} {shared}") for i in range(20)], "doc_id long, text string")
    assert sparse_suffixes.repeats(docs.mapInArrow(count, docs.schema)).count() >= 19
    assert seen.value <= 4 * 20


def test_suffixes_inside_found_repeats_open_no_window(spark):
    """Which suffixes lie in a repeat is told from all spans of a document, in any order, also to the end of its text."""
    rows = [(g, x, p) for g, p in enumerate((0, 10, 24, 60, 90, 130, 170)) for x in (1, 2)]
    alike = spark.createDataFrame(rows, "g long, x long, pos int")
    docs = spark.createDataFrame([(x, " ".join(f"w{i}" for i in range(200))) for x in (1, 2)], "doc_id long, text string")
    spans = [(1, 120, 80, True), (1, 0, 76, False), (1, 30, 100, False)]
    found = spark.createDataFrame(spans, "doc_id long, start long, n_words long, to_end boolean")
    got = {(r.x, r.pos) for r in sparse_suffixes.open_windows(alike, found, docs, "doc_id", "text", 50).collect()}
    around = lambda places: {w for p in places for w in range(max(p - 24, 0), min(p, 150) + 1)}
    inside = {w for s, n in ((120, 80), (0, 76), (30, 100)) for w in range(s, s + n - 49)}
    free = [p for p in (0, 10, 24, 60, 90, 130, 170) if not any(s <= max(p - 24, 0) and (last or p + 50 <= s + n) for _, s, n, last in spans)]
    assert free == [90, 130] and {p for x, p in got if x == 1} == (around(free) - inside)
