"""Every corpus operator against a plain Python version, on texts with odd cases."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from marquee.llm import (bpe, columns, decontaminate, graph, html_text, license_scan, ngram_join, passage_chains, piece_counts,
                         quality_rules, sparse_suffixes, token_files, words as W)
from marquee.session import materialize, scratch_path

MULTI, PLAIN, PIECES = (P.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json"))
CLASHES = "doc_id long, text string, n_words string, failed string, _row int, x int, g int, start int, label string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def prose(rng, n):
    return " ".join(rng.choice("ab") + str(rng.randrange(3000)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Null, empty, spaces only, ties, repeated rows, very long, copies near and exact, shared passages."""
    rng = random.Random(7)
    passage = prose(rng, 60)
    base = prose(rng, 120)
    near = base.split()
    near[50] = "changed"
    out = [None, "", "  \n\t ", "one two", "One TWO", "a b c d e", "a b c d e", base, base, " ".join(near), base.upper(), passage]
    out += [f"{prose(rng, 30)}\n{passage}\n{prose(rng, 40)}" for _ in range(6)]
    out += ["the and\n" * 9, "line one\nline one\n\n \nline two\nline one", "## $$ %% é ÉÀ Ü × ÷ ß 日本 语 x" * 3, prose(rng, 40_000), "word " * 300, "é" * 5000, "x" * 9000]
    out += [prose(rng, rng.randrange(1, 200)) for _ in range(20)]
    out += [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 60))) for _ in range(30)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "s", "f", 1, 2, 3, 4, "l") for i, t in enumerate(texts)]
    return materialize(spark.createDataFrame(rows, CLASHES).repartition(3), "docs").cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], CLASHES)


def by_id(df, key="doc_id"):
    rows = df.collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


def repeat_words(w):
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    return len({j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)})


def test_quality_ledger(docs, texts, none):
    got = by_id(quality_rules.ledger(docs))
    for i, t in enumerate(texts):
        w, r = plain_words(t), got[i]
        lines = [x for x in (t or "").split("\n") if plain_words(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or "")), i
        assert (r.n_lines, r.n_dup_lines, r.n_repeat_words) == (len(lines), len(lines) - len(set(lines)), repeat_words(w)), i
        values = r.asDict()
        assert r.failed == sum(1 << k for k, test in enumerate(quality_rules.RULES.values()) if eval(test, {}, values)), i
    assert quality_rules.ledger(none).count() == 0


def test_quality_policies_and_ablation(docs):
    book = quality_rules.ledger(docs).cache()
    rows = book.collect()
    for r in quality_rules.ablation(book, [quality_rules.BASE, quality_rules.STRICT]).collect():
        full = {p.name: p.mask for p in (quality_rules.BASE, quality_rules.STRICT)}[r.policy]
        rest = full & ~quality_rules.mask(r.rule)
        assert (r.kept, r.kept_without) == (sum(x.failed & full == 0 for x in rows), sum(x.failed & rest == 0 for x in rows))
    kept = quality_rules.keep(docs)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.failed == 0}


def test_html_cases():
    cases = {
        None: "", "": "", "<p>": "",
        "<nav>Home</nav><article><h1>T</h1><p>A &amp; b<br>c\n d</p><p>Be.</p></article><footer>x</footer>": "T\n\nA & b c d\n\nBe.",
        "<article><p>One <b>two</p><p>three <script>var a='<p>no</p>'</script>four<!-- no --></article>": "One two\n\nthree four",
        "<div class=ad>buy<article><p>Kept text</p></article>": "Kept text",
        "<article><p>Text</p><div class='comments'><p>Me too</p></div><aside>no</aside><form>no</form></article><article>later": "Text\n\nlater",
        "<article><p>Text</p></article><section id=comments><article><p>Reader says</p></article></section>": "Text",
        "<article><ul><li><a href=1>More stories here</a></li></ul><p>Body of it</p></article>": "Body of it",
        "<article><p>cut off <b": "cut off",
        "<main><header><h1>Title</h1></header><p>1 &lt; 2 &eacute;&#8217;</p></main>": "Title\n\n1 < 2 é’",
    }
    for html, want in cases.items():
        assert html_text.main_text(html) == want, html
    body = "the cat is on the mat and it was good for all of us there " * 4
    assert html_text.main_text(f"<div>Menu</div><div><h2>Head</h2><p>{body}</p><p>Short.</p></div>").split("\n\n") == ["Menu", "Head", body.strip(), "Short."]
    assert html_text.main_text("<div>" + "zq xv " * 60 + "</div>") == ""


def test_html_text_outside_articles():
    """A story in plain elements stays beside articles that hold teasers or comments."""
    body = ("the cat is on the mat and it was good for all of us there " * 4).strip()
    tale = ("she said that they had been in the house for a year and not out " * 4).strip()
    remark = ("this is what I have to say on it and it is not all there is to say " * 3).strip()
    story = f"<div id=story><h2>Head</h2><p>{body}</p><p>Short.</p><p>{tale}</p></div>"
    want = ["Head", body, "Short.", tale]
    cases = {
        f"{story}<div class=related><article><p>{remark}</p></article></div>": want,
        f"<div class=related><article><p>{remark}</p></article></div>{story}": want,
        f"{story}<section id=comments><article><p>{remark}</p></article></section>": want,
        f"{story}<section id=comments><article><p>{remark}</p></article>": want,  # cut off
        f"{story}<article><p>Teaser of another story</p></article>": [*want, "Teaser of another story"],
        f"<article><p>{remark}</p></article>{story}": [remark, *want],
        f"<div>Home</div><article><p>{remark}</p></article><div>Imprint</div>": [remark],
        f"<div id=page><div class=ad>buy<article><p>{remark}</p></article></div>": [remark],
        f"<form id=page><div>Home</div><article><p>{remark}</p></article></form>": [remark],
    }
    for html, text in cases.items():
        assert html_text.main_text(html).split("\n\n") == text, html


def test_html_table(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    pages = spark.createDataFrame([(1, "u", "<article><p>é b</p></article>", "x", "y"), (1, "u", None, "x", "y"), (None, None, "", None, None)], schema)
    assert sorted(map(tuple, html_text.extract(pages).collect()), key=repr) == sorted([(1, "u", "é b", 3), (1, "u", "", 0), (None, None, "", 0)], key=repr)
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


def brute_contamination(text, items):
    w = folded_words(text)
    hit, found = set(), set()
    for item, t in items:
        b = folded_words(t)
        size = min(13, len(b))
        windows = {tuple(b[i:i + size]) for i in range(len(b) - size + 1)} if b else set()
        for i in range(len(w) - size + 1):
            if size and tuple(w[i:i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item) if item is not None else "")
    told = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), told, bool(hit) and 20 * len(hit) >= len(w)


def test_decontaminate(spark, docs, texts, none):
    passage = texts[11].split()
    items = [(1, " ".join(passage[3:40])), (2, "A, b c! d"), (10, "a b c d"), (3, None), (4, "--"), (None, "one two"), (1, " ".join(passage[3:40])), (5, " ".join(passage[20:33]))]
    benchmark = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id int, text string, n_words string")
    for limit in (decontaminate.BLOCK_BYTES, 200):
        got = by_id(decontaminate.contamination(docs, benchmark, block_bytes=limit))
        for i, t in enumerate(texts):
            r = got[i]
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute_contamination(t, items), (i, limit)
    kept = decontaminate.clean(docs, benchmark)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.contaminated}
    for m in decontaminate.matches(docs, benchmark).collect():
        item = folded_words(dict(items)[int(m.item_id)] if m.item_id else "one two")
        w = folded_words(texts[m.doc_id])
        assert w[m.doc_word:m.doc_word + m.n_words] == item[m.item_word:m.item_word + m.n_words]
    longest = {r.doc_id: r.n_words for r in decontaminate.matches(docs, benchmark).where("item_id = '1'").collect()}
    assert longest[11] == 37
    assert decontaminate.contamination(none, benchmark).count() == 0
    assert {r.n_items for r in decontaminate.contamination(docs, benchmark.where("false")).collect()} == {0}


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    parts = ["a", "aa", " ", "  ", "\n", "\t", "the", " the", "'s", "'", "é", "日本", "\xa0", "　", " ", "1", "12", "½", "😀", "́", "!!", "\r\n",
             "abab", "\x00", "\x85", "×", "<|endoftext|>", "ß", "word.", "don't", "᠎"]
    return [None, ""] + ["".join(rng.choice(parts) for _ in range(rng.randrange(50))) for _ in range(1500)] + ["".join(rng.choice("ab") for _ in range(60)) for _ in range(200)]


def rank_encoding():
    with open(MULTI, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_rank_library(odd_texts):
    own, other = bpe.codec(open(MULTI, "rb").read()), rank_encoding()
    ids, bounds = own.encode(pa.array(odd_texts))
    for i, t in enumerate(odd_texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == other.encode_ordinary(t or ""), repr(t)
    assert own.decode(ids)[0].tobytes().decode() == "".join(t or "" for t in odd_texts)


def test_bpe_tables(spark, docs, texts, none):
    other = rank_encoding()
    got = by_id(bpe.digests(docs, MULTI))
    made = bpe.encode(docs, MULTI).cache()
    back = by_id(bpe.decode(made, MULTI))
    for i, t in enumerate(texts):
        ids = other.encode_ordinary(t or "")
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() and back[i].text == (t or "")
    for r in made.where("doc_id = 20").collect():
        holder = [k for k, c in enumerate(texts[20]) for _ in c.encode()]
        ends = np.cumsum([len(other.decode_single_token_bytes(t)) for t in r.ids]).tolist()
        assert r.ends == [holder[e - 1] + 1 for e in ends] and r.starts == [holder[e] for e in [0, *ends[:-1]]]
    assert bpe.digests(none, MULTI).count() == 0


def test_token_files(spark, docs, texts, none):
    tokenizer = Tokenizer.from_file(PLAIN)
    tokenizer.encode_special_tokens = True
    folder = scratch_path(spark, "files")
    index = materialize(token_files.write(docs, folder, PLAIN), "index")
    got, at = by_id(token_files.read(index, folder)), 0
    place = by_id(index)
    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(folder)
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
        reader = token_files.Reader(store.open_input_file(f"{root}/{place[i].file}"))
        assert reader.document(place[i].place).tolist() == ids
    empty = scratch_path(spark, "files")
    assert token_files.read(materialize(token_files.write(none, empty, PLAIN), "index"), empty).count() == 0


def test_token_frames_are_checked(tmp_path):
    path = tmp_path / "f"
    with pa.OSFile(str(path), "wb") as out:
        writer = token_files.Writer(out, 50_000)
        for n in (5, 70_000, 1, 200_000):
            writer.add(np.arange(n, dtype=np.uint32) % 50_000, np.array([n]))
        writer.close()
    reader = token_files.Reader(pa.memory_map(str(path)))
    assert [len(reader.document(i)) for i in range(4)] == [5, 70_000, 1, 200_000]
    assert reader.document(3)[123_456] == 123_456 % 50_000
    data = bytearray(path.read_bytes())
    data[-12 - len(reader.frames) * 12 + 8 - 12] ^= 1  # a checksum in the seek table
    with pytest.raises(ValueError):
        broken = token_files.Reader(pa.BufferReader(bytes(data)))
        [broken.frame(i) for i in range(len(broken.frames))]


def test_license_scan(spark, texts, none):
    rng = random.Random(5)
    mit = license_scan.TEMPLATES[14].text
    worn = mit.split()
    worn[20] = "altered"
    more = ["Under the GNU General Public License. GNU general public-license!", "MIT License MIT license", "cc by nc 4.0", f"{prose(rng, 30)} {mit}", " ".join(worn), mit.split(" ", 2)[2],
            "license mit", "gnu general public", "all rights reserved", "The Apache\nLicense, 2.0 cc-by", None, ""]
    rows = list(enumerate(texts + more))
    got = by_id(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    phrases = [(t.text.split(), t.label) for t in license_scan.TEMPLATES if t.base]
    for i, t in rows:
        w = folded_words(t)
        at = [(k, label) for p, label in phrases for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
        r = got[i]
        starts = [k for k, _ in at]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    labels = [got[len(texts) + i].labels for i in range(len(more))]
    assert labels == ["gpl", "mit", "cc-by,cc-by-nc", "mit", "mit", "", "", "", "all-rights-reserved", "apache,cc-by", "", ""]
    assert license_scan.scan(none).count() == 0


def test_piece_counts(docs, texts, none):
    vocabulary = set(piece_counts.word_end_vocabulary(open(PIECES, "rb").read()))
    most = max(map(len, vocabulary))

    def greedy(word):
        s, i, n = (*word.encode(), piece_counts.END), 0, 0
        while i < len(s):
            j = next((j for j in range(min(len(s), i + most), i, -1) if s[i:j] in vocabulary), None)
            if j is None:
                return 1
            i, n = j, n + 1
        return n

    memo = {}
    got = by_id(piece_counts.count(docs, PIECES))
    for i, t in enumerate(texts):
        counts = [memo.setdefault(w, None) or memo.update({w: greedy(w)}) or memo[w] for w in plain_words(lowered(t))]
        assert (got[i].n_words, got[i].n_tokens, got[i].longest_word_tokens) == (len(counts), sum(counts), max(counts, default=0)), i
    assert piece_counts.count(none, PIECES).count() == 0


def test_automaton_with_unknown_words():
    rng = random.Random(2)
    for _ in range(60):
        tokens = {tuple(rng.choice([1, 2, 3]) for _ in range(rng.randrange(1, 4))) + ((piece_counts.END,) if rng.random() < 0.5 else ()) for _ in range(8)}
        machine = piece_counts.Automaton(sorted(tokens))
        for _ in range(60):
            word = bytes(rng.choice([1, 2, 3]) for _ in range(rng.randrange(1, 9)))
            s, i, n = (*word, piece_counts.END), 0, 0
            while i < len(s):
                j = next((j for j in range(len(s), i, -1) if s[i:j] in tokens), None)
                if j is None:
                    n = 1
                    break
                i, n = j, n + 1
            assert machine.count(word) == n, (tokens, word)


def shingles(text):
    w = plain_words(lowered(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(ids, sets):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_ngram_join(spark, texts, none):
    rng = random.Random(11)
    base = prose(rng, 60).split()
    chain = []
    for _ in range(25):  # each alike its predecessor, ends far apart
        base = list(base)
        base[rng.randrange(60)] = f"new{rng.randrange(10_000)}"
        chain.append(" ".join(base))
    every = texts + chain
    sets = [shingles(t) for t in every]
    table = spark.createDataFrame([(i, t, 5, "c") for i, t in enumerate(every)], "doc_id long, text string, size int, component_id string").repartition(5)
    got = by_id(ngram_join.join(table))
    want = brute_components(range(len(every)), sets)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), want[i]) for i in want}
    kept = ngram_join.keep_first(table)
    assert kept.schema == table.schema and {r.doc_id for r in kept.collect()} == {i for i in want if want[i] == i}
    assert ngram_join.join(none).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A b c d e f")], "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.join(odd).collect()), key=repr) == sorted([(None, 2, None), (4, 2, 4), (4, 2, 4), (9, 2, 4)], key=repr)


def test_ngram_join_keeps_links_in_full_columns(spark):
    """Columns with many members of different components: every link is found without a common first member."""
    rng = random.Random(4)
    line = prose(rng, 12)
    every = [f"{line} {prose(rng, 1)} x{i // 2} y{i // 2} z{i // 2}" if i % 2 else f"{line} x{i // 2} y{i // 2} z{i // 2}" for i in range(160)]
    sets = [shingles(t) for t in every]
    table = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string").repartition(4)
    got = by_id(ngram_join.join(table))
    assert {i: r.component_id for i, r in got.items()} == brute_components(range(len(every)), sets)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40, 90)] + [(0, i) for i in range(1, 30)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(7, 7)]
    root = {i: i for e in edges for i in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: r for i, r in root.items() if any(i in e and e[0] != e[1] for e in edges)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_heads_across_partitions(spark):
    rows = [(g, x, 7) for g in range(5) for x in range(400)] + [(100 + i, i, 7) for i in range(50)]
    out = columns.heads(spark.createDataFrame(rows, "g long, x long, pos int")).collect()
    assert Counter((r.g, r.x) for r in out if r.g < 5) == Counter((g, x) for g, x, _ in rows if g < 5)
    pairs = columns.pairs_with_heads(spark.createDataFrame(out, "g long, x long, pos int, head_x long, head_pos int")).collect()
    for g in range(5):
        linked = {0}
        todo = [(r.x, r.head_x) for r in pairs if r.g == g]
        for _ in range(5):
            linked |= {x for x, h in todo if h in linked}
        assert linked == set(range(400))


def test_pairs_name_the_first_row_at_any_partition_count(spark):
    rows = [(g, x, 10 * x + g) for g in range(4) for x in range(300)] + [(100 + i, i, 7) for i in range(50)]
    shared = columns.heads(spark.createDataFrame(rows, "g long, x long, pos int").repartition(37))
    pairs = columns.pairs_with_first(materialize(shared, "heads")).collect()
    assert sorted((r.g, r.x, r.pos, r.head_x, r.head_pos) for r in pairs) == [(g, x, 10 * x + g, 0, g) for g in range(4) for x in range(1, 300)]


def test_hot_passage_over_many_partitions(spark):
    """A passage that most documents hold is found in all of them however finely its seeds are dealt out."""
    rng = random.Random(17)
    passage = prose(rng, 60)
    texts = [f"{prose(rng, 5)} {passage} {prose(rng, 5)}" for _ in range(250)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = passage_chains.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = defaultdict(set)
    for r in found:
        got[r.doc_id].update(range(r.start, r.start + r.n_words))
    assert set(got) == set(range(1, 250)) and all(set(range(5, 65)) <= v for v in got.values())


def test_minimisers_hold_every_window():
    rng = np.random.default_rng(1)
    for _ in range(100):
        n = int(rng.integers(5, 150))
        first = np.concatenate([[0], np.sort(rng.integers(0, n, 3)), [n]])
        hashed, k, w = W.mixed(rng.integers(0, 50, n).astype(np.uint64)), 3, int(rng.integers(1, 12))
        got, value = set(W.minimisers(first, hashed, k, w).tolist()), W.runs(hashed, k)
        for a, b in zip(first, first[1:]):
            for i in range(a, b - k - w + 2):
                window = range(i, i + w)
                assert all(p in got for p in window if value[p] == min(value[q] for q in window))


def repeated_passages(texts, size=51):
    """Word places of each text that lie in a stretch of ``size`` words which an earlier text holds too."""
    w = [plain_words(lowered(t)) for t in texts]
    first = {}
    for i, x in enumerate(w):
        for k in range(len(x) - size + 1):
            first.setdefault(tuple(x[k:k + size]), i)
    out = defaultdict(set)
    for i, x in enumerate(w):
        for k in range(len(x) - size + 1):
            if first[tuple(x[k:k + size])] != i:
                out[i].update(range(k, k + size))
    return w, out


def test_passage_chains(docs, texts, none):
    w, want = repeated_passages(texts)
    got = defaultdict(set)
    for r in passage_chains.passages(docs).collect():
        assert r.doc_id > r.other_id and r.n_words >= 50 and r.n_equal <= min(r.n_words, r.other_words)
        assert Counter(w[r.doc_id][r.start:r.start + r.n_words]) & Counter(w[r.other_id][r.other_start:r.other_start + r.other_words])
        got[r.doc_id].update(range(r.start, r.start + r.n_words))
    assert {i for i in want} <= set(got) and all(want[i] <= got[i] for i in want if i < 20)
    assert 9 in got and got[9] == set(range(120))  # the copy with a changed word, as a whole
    clean = {r.doc_id: r.text for r in passage_chains.remove(docs).collect()}
    for i in range(12, 18):
        assert len(plain_words(clean[i])) == 70 and clean[i].split()[:30] == texts[i].split()[:30]
    assert clean[7] == texts[7] and 8 not in clean and clean[0] is None and passage_chains.remove(docs).schema == docs.schema
    assert passage_chains.passages(none).count() == 0 and passage_chains.remove(none).count() == 0


def test_chains_follow_moves_and_gaps():
    p = np.array([0, 10, 20, 40, 50, 300, 310])
    q = np.array([100, 110, 121, 141, 151, 5, 15])
    found = passage_chains.chains(p, q, np.ones(7, np.int64))
    assert [(c[0][0], c[-1][0]) for c in found] == [(0, 20), (300, 300)] or [(c[0][:2], c[-1][1] + c[-1][2]) for c in found][0] == ((0, 100), 159)
    rng = random.Random(9)
    for _ in range(40):  # the chain's score equals a quadratic search
        n = rng.randrange(2, 25)
        p, q = (np.array([rng.randrange(0, 400) * 9 for _ in range(n)]) for _ in range(2))
        ps, qs, size, _ = passage_chains.anchors(p, q, np.ones(n, np.int64))
        score = []
        for i in range(len(ps)):
            best = max([0] + [score[j] - passage_chains.GAP_COST * (ps[i] - ps[j] - size[j] + qs[i] - qs[j] - size[j])
                              for j in range(i) if ps[j] + size[j] <= ps[i] and qs[j] + size[j] <= qs[i]])
            score.append(size[i] + best)
        made = passage_chains.chains(p, q, np.full(n, 2))
        top = max(sum(s for _, _, s in c) - passage_chains.GAP_COST * sum(b[0] - a[0] - a[2] + b[1] - a[1] - a[2] for a, b in zip(c, c[1:])) for c in made)
        assert abs(top - max(score)) < 1e-9


def test_chains_are_cut_where_they_are_not_alike(spark):
    """Two passages far apart, and one with stray seeds around it: the joint stretch is not alike, the passages are."""
    rng = random.Random(13)
    one, two, stray, late = prose(rng, 60), prose(rng, 60), prose(rng, 8), prose(rng, 8)
    texts = [f"{one} {prose(rng, 100)} {two}", f"{one} {prose(rng, 100)} {two}"]
    texts += [f"{stray} {prose(rng, 40)} {three} {prose(rng, 40)} {late}" for three in [prose(rng, 60)] for _ in range(2)]
    texts += [f"{prose(rng, 20)} {four} {prose(rng, 70)} {five} {prose(rng, i)}" for four, five in [(prose(rng, 51), prose(rng, 55))] for i in (90, 400)]
    w, want = repeated_passages(texts)
    got = defaultdict(set)
    for r in passage_chains.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        assert r.n_words >= 50 and r.n_equal >= passage_chains.ALIKE * max(r.n_words, r.other_words)
        both = Counter(w[r.doc_id][r.start:r.start + r.n_words]) & Counter(w[r.other_id][r.other_start:r.other_start + r.other_words])
        assert r.n_equal <= both.total()
        got[r.doc_id].update(range(r.start, r.start + r.n_words))
    assert set(want) == {1, 3, 5} and all(want[i] <= got[i] for i in want)
    # Each document's own words stay.
    assert all(len(got[i]) < len(want[i]) + 25 for i in want)
    for _ in range(200):  # every positive score lies in a part, and no part can be cut or lengthened to a greater sum
        scores = [rng.choice([-5, -3, -2, -1, 1, 2, 3, 4]) for _ in range(rng.randrange(1, 30))]
        parts = passage_chains.best_parts(scores)
        held = [i for a, b in parts for i in range(a, b)]
        assert len(held) == len(set(held)) and {i for i, v in enumerate(scores) if v > 0} <= set(held)
        for a, b in parts:
            assert all(sum(scores[a:k]) > 0 and sum(scores[k:b]) > 0 for k in range(a + 1, b))


def test_parts_of_a_passage_that_first_stand_in_different_documents(spark):
    """Every exact repeat comes out, also where earlier documents hold each of its seeds but not the whole."""
    rng = random.Random(19)
    passage = prose(rng, 60).split()
    own = lambda: prose(rng, 15)
    texts = [f"{own()} {' '.join(passage[a:b])} {own()}" for a, b in ((0, 30), (30, 60), (15, 45), (0, 60), (0, 60), (0, 50))]
    other = prose(rng, 90).split()
    texts += [f"{own()} {' '.join(other[a:a + 30])} {own()}" for a in range(0, 61, 4)]
    texts += [" ".join(other), f"{own()} {' '.join(other[20:71])}", f"{' '.join(other[12:24])} {own()} {' '.join(other[5:66])}"]
    for _ in range(300):  # a small stock of phrases, met in all orders
        texts.append(" ".join(" ".join(other[a:a + rng.randrange(8, 60)]) for a in [rng.randrange(0, 60) for _ in range(4)]))
    w, want = repeated_passages(texts, 50)
    got = defaultdict(set)
    for r in passage_chains.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).collect():
        got[r.doc_id].update(range(r.start, r.start + r.n_words))
    assert {4, 5} <= set(want) and set(want) <= set(got) and all(want[i] <= got[i] for i in want if i < 25)
    for i in want:  # of a stretch that stands in a document twice, the first place
        first = {}
        for k in range(len(w[i]) - 49):
            first.setdefault(tuple(w[i][k:k + 50]), k)
        assert all(set(range(k, k + 50)) <= got[i] for k in first.values() if set(range(k, k + 50)) <= want[i] and any(" ".join(w[i][k:k + 50]) in " ".join(w[j]) for j in range(i)))


def test_sparse_suffixes(docs, texts, none):
    w, want = repeated_passages(texts)
    got = defaultdict(set)
    for r in sparse_suffixes.repeats(docs).collect():
        assert r.doc_id > r.other_id and r.n_words >= 50
        assert w[r.doc_id][r.start:r.start + r.n_words] == w[r.other_id][r.other_start:r.other_start + r.n_words]
        got[r.doc_id].update(range(r.start, r.start + r.n_words))
    assert all(want[i] <= got[i] for i in want if i < 20) and set(want) <= set(got)
    assert sparse_suffixes.repeats(none).count() == 0


def test_inexact_passage_whose_seeds_first_occur_in_many_documents(spark):
    """Every seed of a passage also stands in an earlier document of its own, few times or very often."""
    rng = random.Random(23)
    for holders in (1, 60):
        passage = prose(rng, 96).split()
        changed = [w if i % 24 != 11 else f"new{i}" for i, w in enumerate(passage)]
        # Any window that must hold a seed lies in one of them whole.
        parts = [" ".join(passage[max(i, 0):i + 40]) for i in range(-24, 96, 16)]
        texts = [f"{prose(rng, 40)} {part} {prose(rng, 40)}" for part in parts for _ in range(holders)]
        a, b = len(texts), len(texts) + 1
        texts += [f"{prose(rng, 20)} {' '.join(passage)} {prose(rng, 20)}", f"{prose(rng, 20)} {' '.join(changed)} {prose(rng, 20)}"]
        found = passage_chains.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
        assert {(r.doc_id, r.other_id) for r in found} == {(b, a)}
        assert found[0].n_words >= 90


def test_context_ends_an_extension_only_where_the_texts_do():
    """``stops`` never holds where an extension on the words goes on beyond the context."""
    rng, sure = np.random.default_rng(7), 0
    for _ in range(600):
        x, y = (rng.integers(1, 4, 60).astype(np.uint64) for _ in range(2))
        size = int(rng.integers(0, 60))
        mine, theirs = x[:size], y[:max(0, size - int(rng.integers(0, 3)))]
        held = [np.array([sum(int(w) << 4 * i for i, w in enumerate(v[:passage_chains.CONTEXT].tolist()))], np.uint64).view(np.int64) for v in (mine, theirs)]
        if passage_chains.stops(*held)[0]:
            sure += 1
            assert passage_chains._extend(mine, theirs, 0, 0, 1)[0] <= passage_chains.CONTEXT
    assert sure > 50


def test_documents_alike_in_a_short_phrase_are_not_compared(spark):
    """Many documents share a phrase of 12 words, by tens and by all; two share a changed passage as well."""
    rng = random.Random(31)
    word = lambda: f"w{rng.randrange(10 ** 9)}"
    own = lambda n: " ".join(word() for _ in range(n))
    phrases = [own(12) for _ in range(8)]
    texts = [f"{own(60)} {phrases[i % 7]} {own(60)} {phrases[7]} {own(60)}" for i in range(210)]
    passage = [word() for _ in range(90)]
    changed = [word() if i % 20 == 13 else w for i, w in enumerate(passage)]
    texts += [f"{own(40)} {' '.join(passage)} {own(30)}", f"{own(30)} {' '.join(changed)} {own(40)}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shared = materialize(columns.heads(passage_chains.seeds(docs, "doc_id", "text")), "test-seeds")
    nothing = spark.createDataFrame([], "doc_id long, start long, n_words long, other_id long")
    pairs = {tuple(r) for r in passage_chains.open_pairs(shared, nothing, "doc_id").collect()}
    # Phrases that stand at one distance are compared where both are shared.
    assert (211, 210) in pairs and all((a - b) % 7 == 0 for a, b in pairs - {(211, 210)})
    alone = spark.createDataFrame([(i, f"{own(60)} {phrases[i % 7]} {own(60)}") for i in range(210)], "doc_id long, text string")
    shared = materialize(columns.heads(passage_chains.seeds(alone, "doc_id", "text")), "test-seeds")
    assert shared.count() > 100 and passage_chains.open_pairs(shared, nothing, "doc_id").count() == 0
    assert {(r.doc_id, r.other_id) for r in passage_chains.passages(docs).collect()} == {(211, 210)}


def test_remembered_stretches_outlive_a_full_table(monkeypatch, texts):
    """Ids do not depend on when a new table begins, and what was met in the one before is not encoded again."""
    monkeypatch.setattr(bpe, "REMEMBERED", 1)
    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        use = bpe.Codec(f.read())
    column = pa.array(texts, pa.string())
    ids, bounds = use.encode(column)
    want = [i for t in texts for i in use.tokenizer.encode(t or "", add_special_tokens=False).ids]
    assert ids.tolist() == want and bounds[-1] == len(want)
    calls, real = [], use.tokenizer

    class Counting:
        def encode_batch_fast(self, some, **more):
            calls.extend(some)
            return real.encode_batch_fast(some, **more)

    use.tokenizer = Counting()
    for _ in range(3):
        assert use.encode(column)[0].tolist() == want
    assert not calls


def test_bytes_of_a_column():
    for sizes in ([], [0], [2, 0, 3], [0, 0]):
        column = W.packed(np.frombuffer(b"abcde", np.uint8)[:sum(sizes)], np.array(sizes, np.int64))
        assert W.as_bytes(column) == column.to_pylist() and W.as_bytes(column.slice(1)) == column.slice(1).to_pylist()


def test_slices_hand_memory_back(monkeypatch):
    """Once, when the batches of a task are through."""
    calls = []
    monkeypatch.setattr(W, "_hand_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", None, "c"])], ["text"])
    assert sum(p.num_rows for p in W.slices([batch, batch], "text", 2)) == 6 and calls == [1]
