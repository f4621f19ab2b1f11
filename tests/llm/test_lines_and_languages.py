"""Labels of single lines, training on whole texts, and fused evidence against plain Python."""

import math
import random

import numpy as np
import pytest

from partnerscope.llm import language_id, quality_lines
from partnerscope.llm.common import Work

MENUS = ["Home | About | Contact | Login", "Share this: # $ % | &", ">> next | prev <<", "| 12 | 34 | $5 |", "*** *** ***"]
WORDS = "river stone window garden morning teacher letter market winter summer yellow simple gather answer".split()


def prose(draw):
    return " ".join(draw.choice(WORDS) for _ in range(draw.randrange(8, 30))).capitalize() + "."


def junk(draw):
    if draw.random() < 0.3:  # a menu of other words than those of MENUS
        return draw.choice([" | ", " & ", " # "]).join(draw.choice(WORDS).capitalize() for _ in range(draw.randrange(2, 6)))
    return " ".join(draw.choice(["###", "$$$", "|", "%%", "A1", "&&", "77", "<>"]) for _ in range(draw.randrange(3, 9)))


@pytest.fixture(scope="module")
def field():
    """Learned from documents that are good but for some lines, or bad but for some lines."""
    draw = random.Random(4)
    good = ["\n".join(junk(draw) if draw.random() < 0.1 else prose(draw) for _ in range(draw.randrange(1, 9))) for _ in range(300)]
    bad = ["\n".join(prose(draw) if draw.random() < 0.1 else junk(draw) for _ in range(draw.randrange(1, 9))) for _ in range(300)]
    return quality_lines.train(good + bad, [1] * 300 + [0] * 300)


def found(field, docs):
    batch = quality_lines.Batch(["\n".join(lines) for lines in docs])
    return field.decode(batch.features, batch.line_doc, len(docs))


def test_boilerplate_inside_good_documents(field):
    draw = random.Random(5)
    docs = [[draw.choice(MENUS), *[prose(draw) for _ in range(4)], draw.choice(MENUS)] for _ in range(300)]
    labels = found(field, docs).reshape(300, 6)
    assert (labels[:, [0, 5]] == 0).mean() > 0.9 and (labels[:, 1:5] == 1).mean() > 0.9


def test_good_lines_inside_bad_documents(field):
    draw = random.Random(6)
    docs = [[junk(draw), junk(draw), prose(draw), junk(draw), junk(draw)] for _ in range(300)]
    labels = found(field, docs).reshape(300, 5)
    assert (labels[:, 2] == 1).mean() > 0.9 and (labels[:, [0, 1, 3, 4]] == 0).mean() > 0.9


def test_training_uses_all_lines():
    """The lines that tell good from bad come after the first thousand."""
    draw = random.Random(7)
    same = [prose(draw) for _ in range(1000)]
    texts = ["\n".join(same + [line(draw) for _ in range(1500)]) for line in (prose, junk) for _ in range(3)]
    learned = quality_lines.train(texts, [1, 1, 1, 0, 0, 0])
    labels = found(learned, [[junk(draw)] * 5 + [prose(draw)] * 5])
    assert labels.tolist() == [0] * 5 + [1] * 5


def test_chains_hold_every_line_and_weigh_at_most_64():
    sizes = [1, 64, 65, 0, 200]
    line_doc = np.repeat(np.arange(5), sizes)
    chains = quality_lines.Chains(np.ones((len(line_doc), 2)), line_doc, 5)
    assert chains.held.sum() == sum(sizes) and chains.held.shape[1] == 64
    weights = np.bincount(line_doc, (chains.weight[chains.chain]), minlength=5)
    assert weights == pytest.approx([1, 64, 64, 0, 64])


def test_fit_in_tasks_equals_training_at_once(spark):
    draw = random.Random(8)
    rows = [(k, "\n".join((prose if k % 2 else junk)(draw) for _ in range(1 + k % 90)), k % 2) for k in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, quality int, toxic int")
    made = quality_lines.fit(docs, labels)
    plain = quality_lines.train([r[1] for r in rows], [r[2] for r in rows])
    assert made.weights == pytest.approx(plain.weights, abs=0.05) and made.pairs == pytest.approx(plain.pairs, abs=0.05)


# ------------------------------------------------------------------- languages


def plain_posteriors(rows, n):
    """Posterior of each row ``(host, domain, suffix, declared, text, alone)`` by nested loops."""
    made = []
    for k, row in enumerate(rows):
        others = [r for j, r in enumerate(rows) if j != k]

        def sums(test, others=others):
            return [sum(r[5][i] for r in others if test(r)) for i in range(n)]

        def smoothed(own, above, weight):
            return [(s + weight * p) / (sum(own) + weight) for s, p in zip(own, above, strict=True)]

        prior = smoothed(sums(lambda r: True), [1 / n] * n, 1.0)
        for level in (2, 1, 0):
            if row[level] is not None:
                prior = smoothed(sums(lambda r, level=level, row=row: r[level] == row[level]), prior, language_id.LEVEL_WEIGHT)
        says = [1.0] * n
        if row[3] is not None:
            declaring, pages = sums(lambda r, row=row: r[3] == row[3]), sums(lambda r: r[3] is not None)
            share = (sum(declaring) + 0.5) / (sum(pages) + 1.0)
            weight = language_id.DECLARED_WEIGHT
            says = [(d + weight * share) / (p + weight) for d, p in zip(declaring, pages, strict=True)]
        shares = [s * p * math.exp(t) for s, p, t in zip(says, prior, row[4], strict=True)]
        made.append([x / sum(shares) for x in shares])
    return made


def test_fused_evidence(spark):
    draw = random.Random(9)
    rows = []
    for _ in range(60):
        text = [0.0, -draw.random() * 3, -draw.random() * 3]
        draw.shuffle(text)
        total = sum(map(math.exp, text))
        site = draw.choice([(None, None, None), ("a.x.fr", "x.fr", "fr"), ("b.x.fr", "x.fr", "fr"), ("y.de", "y.de", "de"), ("10.0.0.1", None, None)])
        rows.append((*site, draw.choice(["fr", "de", None]), text, [math.exp(t) / total for t in text]))
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"page_id long, {language_id.EVIDENCE}")
    made = language_id.fused(frame, ["de", "en", "fr"], Work(spark, "test"))
    by_id = {r["page_id"]: r["posterior"] for r in made.select("page_id", "posterior").collect()}
    for k, expected in enumerate(plain_posteriors(rows, 3)):
        assert by_id[k] == pytest.approx(expected, abs=1e-9)


def test_whole_texts_teach_runs(spark):
    """The languages differ only far behind the first letters of their texts."""
    start = "zzz " * 3000
    known = [(k, start + ("the house and the tree " if k % 2 else "la maison et le jardin ") * 50, "en" if k % 2 else "fr") for k in range(8)]
    model = language_id.fit(spark.createDataFrame(known, "doc_id long, text string, lang string"))
    likely = model.log_likelihoods("the tree and the house")
    assert likely[model.languages.index("en")] > likely[model.languages.index("fr")]


def test_all_languages_or_an_error(spark):
    known = [(k, f"text number {k}", f"l{k:03d}") for k in range(language_id.MAX_LANGUAGES + 1)]
    frame = spark.createDataFrame(known, "doc_id long, text string, lang string").coalesce(1)
    assert len(language_id.fit(frame.where("doc_id < 300")).languages) == 300
    with pytest.raises(ValueError, match="languages"):
        language_id.fit(frame)


def test_text_beside_the_main_part_counts(spark):
    known = [(k, "the house and the tree" if k % 2 else "la maison et le jardin", "en" if k % 2 else "fr") for k in range(8)]
    model = language_id.fit(spark.createDataFrame(known, "doc_id long, text string, lang string"))
    html = "<body><article><p>the tree</p></article><div><p>" + "la maison et le jardin " * 20 + "</p></div></body>"
    page = spark.createDataFrame([(1, "http://a.example/", html)], "page_id long, url string, html string")
    assert language_id.identify_pages(page, model).first()["lang"] == "fr"
