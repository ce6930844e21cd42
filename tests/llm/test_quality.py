import random
import sys
from pathlib import Path

import numpy as np
import pytest

from corpusloom.llm import quality as Q
from corpusloom.llm import text_stats
from corpusloom.llm.text_stats import FEATURES, CommonWords, batch_statistics

sys.path.insert(0, str(Path(__file__).parent))
from plain_statistics import text_statistics as plain  # noqa: E402

EN = frozenset("the of and to a in is that it for you as with be on this are by not or if from when can at its".split())
WORDS = CommonWords((EN,))
INDEX = {f: i for i, f in enumerate(FEATURES)}


def figure(text, name):
    return batch_statistics([text], WORDS)[0, INDEX[name]]


def test_figures():
    prose = "It is known that the value of this field can be set to a number. When it is set, the view is drawn.\n"
    assert figure(prose, "common_words") > 0.5 and figure(prose, "punctuated_lines") == 1 and figure(prose, "running_share") > 0.9
    assert figure("- red box\n- blue box\n", "item_lines") == 1 and figure("- red box\n- blue box\n", "running_share") == 0
    assert figure("%%% @@@ ***", "symbol_ratio") == 1
    assert figure("1234 5678", "digit_ratio") == 1
    assert figure("Same line here.\n" * 30, "repeated_segments") > 0.9
    assert figure("これは画面が表示される前に一度だけ作成されます。", "running_share") == 1
    assert not batch_statistics(["", " \n\t"], WORDS).any()
    for odd in ("\ud800", "😀" * 50, "x" * 200_000, "!" * 200_000 + "a", "a " * 100_000 + "|", " = " * 50_000, "\x00", "a"):
        assert np.isfinite(batch_statistics([odd, "a"], WORDS)).all()
    assert np.isfinite(batch_statistics(["word"], CommonWords(()))).all() and batch_statistics([], WORDS).shape == (0, len(FEATURES))


def test_figures_equal_the_plain_ones(monkeypatch):
    """Texts of pieces that open, close and break lines, cells, segments and sentences, in blocks of several texts."""
    rng = random.Random(5)
    pieces = ["the value of it", "Name", " : ", " | ", "\t", "\n", "\n\n", "- ", "* ", "1. ", "(a) ", " - ", "    ", ". ", "... ", "? ", "!", ";", "”", "ÄÖ é", "これは画面が", "。", "カタカナ、", "漢字", "12.5", "x = y", "# ", "_a_", "x", " ", "\u00a0", "😀", "of the"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60))) for _ in range(600)] + ["", " "]
    languages = (frozenset(), EN, frozenset({"value", "name", "é"}))
    want = np.array([plain(t, languages) for t in texts])
    for block in (1, 700, 1 << 20):
        monkeypatch.setattr(text_stats, "BLOCK_CHARS", block)
        got = batch_statistics(texts, CommonWords(languages))
        assert not {f: texts[int(np.argmax(np.abs(got[:, k] - want[:, k])))] for k, f in enumerate(FEATURES) if not np.allclose(got[:, k], want[:, k])}


def corpus():
    rng = random.Random(0)
    nouns = [f"{a}{b}" for a in ("view", "cell", "lock", "path", "form", "rule") for b in ("er", "ing", "s", "box")]
    common = sorted(EN)
    texts, labels = [], []
    for _ in range(400):
        kind = rng.choice(["prose", "prose", "list", "table", "junk"])
        n = rng.randrange(6, 25)
        if kind == "prose":
            text = " ".join(" ".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(nouns) for _ in range(rng.randrange(8, 16))).capitalize() + "." for _ in range(n))
        elif kind == "list":
            text = "\n".join(f"- {rng.choice(nouns)} {rng.choice(nouns)}" for _ in range(n))
        elif kind == "table":
            text = "\n".join(" | ".join(str(rng.randrange(1000)) for _ in range(5)) for _ in range(n))
        else:
            text = "".join(rng.choice("#$%&@^~_=+<>{}") for _ in range(30 * n))
        texts.append(text)
        labels.append(kind)
    return texts, labels


@pytest.fixture(scope="module")
def frames(spark):
    texts, labels = corpus()
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(1000, None, None), (1001, "  \n", "x"), (1001, "  \n", "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, blank string")
    words = spark.createDataFrame([("en", w) for w in EN] + [(None, None), ("en", "the")], "lang string, word string")
    rng = random.Random(1)
    marks = [(i, rng.choice(Q.CLASSES) if rng.random() < 0.05 else c) for i, c in enumerate(labels) if i % 2 == 0] + [(0, "unheard of"), (1, None), (None, "prose"), (1000, "prose"), (77777, "junk")]
    return documents, words, spark.createDataFrame(marks, "doc_id long, label string"), labels


def test_held_out_accuracy(frames):
    documents, words, marks, labels = frames
    rows = Q.text_quality(documents, words, marks).collect()
    got = {r.doc_id: r.text_class for r in rows}
    held = [i for i in range(len(labels)) if i % 2]
    assert len(rows) == 403
    assert sum(got[i] == labels[i] for i in held) >= 0.95 * len(held)
    assert got[1000] == got[1001] == "junk"


def test_without_labels_or_rows(frames):
    documents, words, marks, _ = frames
    got = {r.doc_id: r.text_class for r in Q.text_quality(documents, words, marks.where("false")).collect()}
    assert got[0] == "prose" and got[1000] == "junk"
    assert Q.text_quality(documents.where("false"), words.where("false"), marks).count() == 0


def test_step_raises_the_likelihood():
    rng = np.random.default_rng(0)
    d = len(FEATURES)
    z = np.concatenate([rng.normal(size=(300, d)), rng.normal(size=(300, d)) * 0.5 + 3])
    centres = Q._seeds(z, 4)
    model = Q.Mixture(np.zeros(d), np.ones(d), np.full(4, 0.25), centres, np.stack([np.eye(d)] * 4), np.zeros((4, 4)))
    logs = []
    for _ in range(8):
        sums = Q._step_sums(z, model.theta())
        logs.append(sums[-1])
        model = Q._next(model, sums, d)
    assert logs == sorted(logs) and logs[-1] > logs[0]
    r = model.responsibilities(z)
    assert np.allclose(r.sum(axis=1), 1)
