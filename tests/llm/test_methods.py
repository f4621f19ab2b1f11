"""The parts that the operators are made of."""

import sys
from itertools import product
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from partnerscope.llm import (  # noqa: E402
    components,
    decontaminate,
    minhash,
    packing,
    quality_lines,
    substring,
    token_counts,
    toxicity,
)
from partnerscope.llm.common import Work  # noqa: E402

LETTERS = st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aZé'sll't  \n\tΣσ1²½<|>")), max_size=40)


@settings(deadline=None, max_examples=300)
@given(LETTERS)
def test_byte_ids_are_those_of_the_library(text):
    encoder = packing.byte_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert list(encoder.ids(text)) == encoder.exact.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=300)
@given(st.lists(st.one_of(LETTERS, st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|"])), max_size=4).map("".join))
def test_token_counts_are_those_of_the_library(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    counter = token_counts._worker_counter(path, b'[["the", "a"], [1, 1]]')
    assert counter.count(text) == len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


@settings(deadline=None, max_examples=200)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 60), max_size=32))
def test_plan_places_every_piece(counts):
    plan = packing.packing_plan(counts, 32)
    placed = {}
    for content, number in plan:
        assert number > 0 and sum(length * each for length, each in content) <= 32
        for length, each in content:
            placed[length] = placed.get(length, 0) + each * number
    assert placed == counts


def test_complements_fill_exactly():
    groups, left = packing.exact_complements({32: 2, 20: 3, 12: 2, 10: 4, 11: 2}, 32)
    assert left == {20: 1, 10: 3}
    assert groups == [(((32, 1),), 2), (((20, 1), (12, 1)), 2), (((11, 2), (10, 1)), 1)]


@settings(deadline=None, max_examples=100)
@given(st.lists(st.text("ab", min_size=3, max_size=7), min_size=1, max_size=4), st.text("abc", max_size=9))
def test_automata_find_the_nearest_term(terms, word):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    allowed = lambda t: next(n for least, n in toxicity.EDITS if len(t) >= least)
    expected = [distance(t, word) for t in set(terms) if distance(t, word) <= allowed(t)]
    found = toxicity.NearTerms({t: 1.0 for t in terms}).hit(word)
    assert (found[0] if found else None) == (min(expected) if expected else None)


def test_a_quoted_word_is_a_mention():
    matcher = toxicity.Matcher({"moron": 5.0})
    used, _, mentioned, *_ = matcher.evidence("what a moron you are")
    assert used and not mentioned
    for text in ("he said \"moron\" twice", "the so-called “moron” is a word", "the word moron is old"):
        used, _, mentioned, *_ = matcher.evidence(text)
        assert mentioned and not used, text
    assert matcher.evidence("what a morron")[1] == 5.0


@settings(deadline=None, max_examples=60)
@given(st.lists(st.floats(-3, 3), min_size=1, max_size=7), st.lists(st.floats(-2, 2), min_size=4, max_size=4), st.integers(1, 3))
def test_decoding_finds_the_best_sequence(scores, pairs, docs):
    pairs = np.array(pairs).reshape(2, 2)
    line_doc = np.sort(np.arange(len(scores)) % docs)
    found = quality_lines.viterbi(np.array(scores), pairs, line_doc, docs)

    def total(labels, own):
        return sum(s * x for s, x in zip(own, labels)) + sum(pairs[a, b] for a, b in zip(labels, labels[1:]))

    for doc in range(docs):
        own = [s for s, d in zip(scores, line_doc) if d == doc]
        best = max((total(x, own) for x in product((0, 1), repeat=len(own))), default=0)
        assert total([int(x) for x, d in zip(found, line_doc) if d == doc], own) == pytest.approx(best)


def test_training_learns_labels():
    good = ["This is a sentence of plain words that ends well.\nAnd here is another one of some length."] * 3
    bad = ["### $$$ %%% ###\n*** &&& ***", "$$$ $$$ ###\n%% %% %%", "a | b | c\n### ###"]
    field = quality_lines.train([f"{i} {t}" for i, t in enumerate(good + bad)], [1, 1, 1, 0, 0, 0])
    found = quality_lines.judge(good + bad, field)["content_share"]
    assert (found[:3] >= 0.5).all() and (found[3:] < 0.5).all()


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(50, 52), (52, 51)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = dict(components.components(frame, Work(spark, "test")).select("node", "label").collect())
    assert all(found[k] == 1 for k in range(1, 41)) and all(found[k] == 100 for k in range(100, 130))
    assert found[51] == found[52] == 50


@settings(deadline=None, max_examples=40)
@given(st.integers(2, 1200), st.sampled_from([80, 85]), st.randoms(use_true_random=False))
def test_linked_sets_share_a_band_and_look_plausible(n, percent, random):
    allowed = n * (100 - percent) // percent
    words = [f"w{random.random()}" for _ in range(n + 2)]
    cut = random.randint(0, min(allowed, n + 1)) if allowed else 0
    one, two = minhash.shingle_set(" ".join(words), 1), minhash.shingle_set(" ".join(words[: len(words) - cut]), 1)
    if not minhash.linked(one, two, percent):
        return
    keys = []
    for own in (one, two):
        regs = minhash.all_registers(own, percent)
        levels = minhash.band_levels(np.array([len(own)]), percent)
        keys.append({k for level, chosen in levels.items() if chosen[0] for k in minhash.all_band_keys([regs], level)[0] if k})
    assert keys[0] & keys[1] or len(one) == len(two)
    assert minhash.similar_enough(minhash.registers(one), minhash.registers(two), len(one), len(two), percent)


def test_estimate_is_corrected_for_chance():
    assert 0 < minhash.chance_agreement(80, 80) < 0.01


def test_a_large_group_whose_first_member_is_no_hub(spark):
    """Copies that are near the middle one only, and two that only each other are near."""
    base = [f"b{k}" for k in range(400)]
    rows = [(500, " ".join(base))]
    for k in range(40):
        own = list(base)
        for j in range(7):
            own[(k * 11 + j * 53) % 400] = f"x{k}-{j}"
        rows.append((k, " ".join(own)))
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    sys.path.insert(0, str(Path(__file__).resolve().parent))
    import plain

    assert found == {i: c for i, (_, c) in plain.near_copies(rows, 3, 85).items()}


def test_retrieval_is_all_items_above_the_threshold():
    texts = ["alpha beta gamma delta epsilon zeta", "alpha beta gamma one two three", "one two three four five six seven"]
    items = [decontaminate.Item(k, t.split(), []) for k, t in enumerate(texts)]
    frequency = {w: sum(w in t.split() for t in texts) for t in texts for w in t.split()}
    index = decontaminate.ItemIndex(items, frequency, 3, 6.3)
    for query in (texts[0], texts[1] + " four", "alpha beta one two four five", "nothing"):
        words = set(query.split())
        shares = [sum(s for w in words & set(i.words) for n, s in zip(index.numbers[w], index.shares[w]) if n == k) for k, i in enumerate(items)]
        assert sorted(index.retrieve(words)) == [k for k, s in enumerate(shares) if s >= decontaminate.THRESHOLD - 1e-9]


@settings(deadline=None, max_examples=80)
@given(st.lists(st.tuples(st.integers(0, 5), st.text("ab ", max_size=40)), max_size=6), st.integers(1, 6))
def test_one_chunk_alone_resolves_its_own_repeats(rows, window):
    sys.path.insert(0, str(Path(__file__).resolve().parent))
    import plain

    own = substring.Parse([t for _, t in rows], np.array([i for i, _ in rows], dtype=np.int64), window, 4)
    goes = own.removed([], [])
    expected = plain.repeats(rows, window)
    assert int(goes.sum()) == sum(x[1] for x in expected)


def test_kept_text_keeps_its_blanks():
    text = "a  b\tc\nd e"
    gone = np.array([False, True, True, False, False])
    assert substring.kept_text(text, gone) == "a  d e"
    assert substring.kept_text(text, ~gone) == "b\tc\n"
    assert substring.kept_text(text, np.ones(5, bool)) == ""


@settings(deadline=None, max_examples=60)
@given(st.sets(st.integers(0, 3000), max_size=900), st.sets(st.integers(0, 3000), max_size=900))
def test_bitmaps_bound_the_difference(one, two):
    sets = [minhash.shingle_set(" ".join(f"w{x}" for x in sorted(s)), 1) for s in (one, two)]
    maps = [minhash.bitmap(s).view(np.uint64) for s in sets]
    assert int(np.bitwise_count(maps[0] ^ maps[1]).sum()) <= len(np.setxor1d(*sets))


def shared_keys(one, two, percent):
    keys = []
    for own in (one, two):
        regs = minhash.all_registers(own, percent)
        levels = minhash.band_levels(np.array([len(own)]), percent)
        held = {int(k) for level, chosen in levels.items() if chosen[0] for k in minhash.all_band_keys([regs], level)[0] if k}
        keys.append(held | {int(k) for k in minhash.least_keys(own, regs, percent)})
    return keys[0] & keys[1]


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_small_sets_always_share_a_key(percent):
    """As many missing shingles as a link allows, and half of them on either side."""
    random = np.random.default_rng(7)
    for n in range(2, 51):
        for _ in range(40):
            for extra in {n * (100 - percent) // percent, 1} - {0}:  # equal sets are one class
                drawn = random.integers(0, 1 << 63, n + extra, dtype=np.uint64)
                for one, two in ((drawn[:n], drawn), (drawn[: n + extra // 2], drawn[extra - extra // 2 :])):
                    one, two = np.sort(one), np.sort(two)
                    if minhash.linked(one, two, percent):
                        assert shared_keys(one, two, percent), (n, extra)
                        few = minhash.registers(one), minhash.registers(two)
                        assert minhash.similar_enough(*few, len(one), len(two), percent)


def test_short_texts_whose_common_shingles_lie_in_one_band_are_linked(spark):
    """Eight words against the same and one more, where only empty bands agree."""
    sys.path.insert(0, str(Path(__file__).resolve().parent))
    import plain

    rows, k = [], 0
    while len(rows) < 20:
        k += 1
        long = " ".join(f"v{k}-{j}" for j in range(9))
        short = long.rsplit(" ", 1)[0]
        held = [minhash.registers(minhash.shingle_set(t, 5)).reshape(2, 64).any(axis=1) for t in (short, long)]
        if held[0].sum() == 1 and held[1].sum() == 2:
            rows += [(len(rows), short), (len(rows) + 1, long)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_copies(frame, 5, 80).collect()}
    assert found == {i: c for i, (_, c) in plain.near_copies(rows, 5, 80).items()}
    assert all(found[i] == i - i % 2 for i in found)


def test_two_edits_and_swaps_in_terms_of_eight_letters_and_more():
    matcher = toxicity.Matcher({"pathetic": 5.0, "worthless": 5.0, "disgusting": 5.0, "disgraceful": 5.0})
    swapped = ["ptahetic", "wrothless", "worhtless", "disgutsing", "digsraceful"]
    for word in [*swapped, "pathtc", "wurthles", "dizgustin", "disgracefuull"]:
        assert matcher.evidence(f"you are {word} today")[1] == 5.0, word
    for term in ("pathetic", "worthless", "disgusting", "disgraceful"):
        for k in range(len(term) - 1):
            word = term[:k] + term[k + 1] + term[k] + term[k + 2 :]
            assert matcher.token_hit(word) is not None, word
