"""Language-model scores, collocations and spelling variants against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from partnerscope.llm import blocks, collocations, lm_score, spelling
from partnerscope.llm.common import table
from partnerscope.llm.word_hash import Splitter

duckdb = pytest.importorskip("duckdb")
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " \t\n", "Äß ÄSS äß", "a" * 5000, "one two " * 4000, "x\x0by\x0cz\rw", "é" * 70 + " " + "é" * 71, "a.b,c;d:e!f?g"]


def documents(spark, texts, first=0):
    rows = [(first + k, t, "en" if k % 2 else None, "clash") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, word string")


def tokens_of(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")] + ["</s>"]


# ------------------------------------------------------------------ words and runs


def test_words_are_hashed_alike_everywhere():
    texts = ["Ab cd\tab  AB\n\ncd", "", "x" * 200 + " " + "x" * 201, "é É", "ab"]
    words = Splitter(b" \t\n\v\f\r").words([t.encode() for t in texts])
    plain = [w.translate(LOWER) for t in texts for w in WORD.findall(t)]
    assert [words.word(k) for k in range(len(plain))] == plain
    assert words.lengths.tolist() == [len(WORD.findall(t)) for t in texts]
    assert len(set(words.hash.tolist())) == len(set(plain))
    assert {(h, p) for h, p in zip(words.hash.tolist(), plain, strict=True)} == set(dict(zip(words.hash.tolist(), plain, strict=True)).items())


def test_runs_come_back():
    draw = np.random.default_rng(1)
    keys = draw.integers(0, 2**64, 5000, dtype=np.uint64)
    keys = np.concatenate([keys, keys[:700], np.array([0, 2**64 - 1], np.uint64)])
    parts = [list(blocks.cut(*blocks.counted(k), 7)) for k in np.array_split(keys, 3)]
    found = Counter()
    for b in range(7):
        own = [r for part in parts for k, r in part if k == b]
        k, n = blocks.merged(own)
        assert (np.diff(k.astype(object)) > 0).all() and (blocks.block_of(k, 7) == b).all()
        found.update(dict(zip(k.tolist(), n.tolist(), strict=True)))
    assert found == Counter(keys.tolist())


# ------------------------------------------------------------------ language model


def plain_base(rows):
    train = Counter()
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 10:
            train.update(tokens_of(text))
    n, v = sum(train.values()), len(train)
    for i, text in rows:
        own = tokens_of(text)
        base = sum(math.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        yield i, (zlib.crc32(str(i).encode()) % 10 == 0, len(own), sum(train[t] > 0 for t in own), n, base)


def check_scores(found, rows):
    for i, (held, n, known, train, base) in plain_base(rows):
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and -1e9 < r["score"] <= 0


def test_scores(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = {r["doc_id"]: r for r in lm_score.scored_documents(docs).collect()}
    assert len(found) == len(rows)
    check_scores(found, rows)
    learned = [r for r in found.values() if not r["held_out"]]
    assert all(r["score"] > r["base_score"] for r in learned)


def test_scores_of_odd_texts(spark):
    rows = list(enumerate(ODD * 3))
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, held_out int")
    check_scores({r["doc_id"]: r for r in lm_score.scored_documents(docs).collect()}, rows)
    assert lm_score.scored_documents(docs.limit(0)).count() == 0
    held = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 10 = 0")
    assert all(r["score"] == pytest.approx(r["base_score"]) and r["train_tokens"] == 0 for r in lm_score.scored_documents(held).collect())
    twice = docs.unionAll(docs)
    assert lm_score.scored_documents(twice).count() == 2 * len(rows)


def test_held_out_copies_are_likely(spark):
    """A text whose like was learned from is far likelier by the model than by its words."""
    draw = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(draw.choices(words, k=60)) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(texts * 2)]
    found = [r for r in lm_score.scored_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["held_out"]]
    assert found and sum(r["score"] > 0.5 * r["base_score"] for r in found) >= 0.9 * len(found)


def test_filter_holds_every_level():
    draw = np.random.default_rng(2)
    keys = np.unique(draw.integers(0, 2**64, 20_000, dtype=np.uint64))
    counts = draw.geometric(0.3, len(keys))
    cells = lm_score.bloom(keys, counts)
    assert (lm_score.probed(cells, keys) >= lm_score.level(counts)).all()
    assert (lm_score.probed(cells, keys) == lm_score.level(counts)).mean() > 0.95
    others = draw.integers(0, 2**64, 20_000, dtype=np.uint64)
    assert (lm_score.probed(cells, others) > 0).mean() < 0.05
    assert lm_score.level(np.array([1, 2, 3, 4, 5, 6])).tolist() == [1, 2, 3, 4, 4, 5]


# ------------------------------------------------------------------ collocations


@pytest.mark.parametrize("container, entries", [(8, 50), (3, 1000), (8192, 1_200_000)])
def test_trie_counts(container, entries):
    draw = np.random.default_rng(5)
    trie = collocations.HatTrie(container, entries)
    expected, found = Counter(), Counter()
    for _ in range(30):
        keys = (draw.zipf(1.4, 200) % 40).astype(np.uint64) << np.uint64(32) | (draw.zipf(1.3, 200) % 50).astype(np.uint64)
        expected.update(keys.tolist())
        trie.add(keys)
        while trie.full():
            k, n = trie.spill()
            assert (np.diff(k.astype(object)) > 0).all()
            for key, number in zip(k.tolist(), n.tolist(), strict=True):
                found[key] += number
        assert trie.entries == sum(map(len, trie.tables)) <= entries and trie.starts == sorted(trie.starts)
        assert all(len(t) <= container for t in trie.tables)
    for key, number in zip(*(x.tolist() for x in trie.spill(1.0)), strict=True):
        found[key] += number
    assert found == expected and trie.entries == 0


def by_sql(docs, least):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    if rows:
        connection.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return sorted(connection.execute(collocations.oracle_sql(least)).fetchall())


def test_collocations_of_drawn_texts(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_KEYS", 200)
    draw = random.Random(4)
    words = ["the", "of", "New", "york", "City", "hall", "a-b", "é", "É", "x" * 90]
    texts = [draw.choice([" ", ". ", ", ", "\n", "\t"]).join(" ".join(draw.choices(words, k=draw.randint(1, 6))) for _ in range(8)) for _ in range(200)]
    docs = documents(spark, texts + ODD)
    found = sorted(tuple(r) for r in collocations.collocations(docs, least=3).collect())
    assert found == by_sql(docs, 3) and len(found) > 50


def test_no_collocations(spark):
    assert collocations.collocations(documents(spark, ["a b", None, ""])).count() == 0
    assert collocations.collocations(documents(spark, ["x"]).limit(0)).count() == 0


# ------------------------------------------------------------------ spelling


def plain_variants(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    apart = lambda a, b: spelling.differ_by_one(a.encode("latin-1"), b.encode("latin-1"))
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and apart(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        if others and words[best := min(others, key=lambda v: (-words[v], v))] >= 10 * words[w]:
            form[w] = best
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        yield w, n, len(near[w]), form.get(w), words.get(form.get(w)), root


def drawn_words(draw, n):
    """Words, and for each a few with letters changed, that occur ten and a hundred times less."""
    for _ in range(n):
        word = "".join(draw.choices("abcdeéßtøin", k=draw.randint(7, 12)))
        for times in (200, 20, 2):
            yield from [word] * times
            at = draw.randrange(len(word))
            word = draw.choice([word[:at] + word[at + 1 :], word[:at] + draw.choice("aeo") + word[at:], word[:at] + "z" + word[at + 1 :]])


def test_differ_by_one():
    cases = [("abc", "abc", 0), ("abc", "abd", 1), ("abc", "ab", 1), ("abc", "xabc", 1), ("abc", "acb", 0), ("abc", "abxc", 1), ("aab", "ab", 1), ("abc", "a", 0)]
    for a, b, near in cases:
        assert spelling.differ_by_one(a.encode(), b.encode()) == spelling.differ_by_one(b.encode(), a.encode()) == bool(near)
        long = ["q" * 6 + x for x in (a, b)], ["q" * 90 + x for x in (a, b)]
        for x, y in long:
            one, two = (spelling.Letters([w.encode()]) for w in (x, y))
            assert spelling.one_apart(one, two, np.array([0]), np.array([0])).tolist() == [bool(near)]


@pytest.mark.parametrize("trie_words, aimed", [(20_000, 8_000), (7, 5)])
def test_variants(spark, monkeypatch, trie_words, aimed):
    monkeypatch.setattr(spelling, "TRIE_WORDS", trie_words)
    monkeypatch.setattr(spelling, "AIMED", aimed)
    draw = random.Random(6)
    words = list(drawn_words(draw, 25)) + ["e" * 40, "e" * 41, "e" * 42] * 3 + ["t" * 100, "t" * 99] * 5
    draw.shuffle(words)
    rows = [(k, " ".join(words[k::40]).upper() if k % 2 else "-".join(words[k::40])) for k in range(40)]
    rows += [(900 + k, t) for k, t in enumerate(ODD)] + [(None, "nothing nothing deleted")]
    found = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n"))
    columns = ("word", "n", "n_near", "form", "form_n", "root")
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=str) == sorted(plain_variants(rows), key=str)


def test_no_words(spark):
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (2, "short")], "doc_id long, text string")).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
