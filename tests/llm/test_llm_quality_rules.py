import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.edges import ROWS, awkward, empty
from trustlake.llm import quality_rules
from trustlake.llm.quality_rules import LanguageModel, SortedHashes, UNTRAINED, four_grams, half, judge_documents, log_perplexity, plain_counts

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    met = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if met[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def symbol(c):
    """By the definition, one character at a time."""
    if c in " \t\n\v\f\r":
        return [0]
    if c.isascii() and c.isalpha():
        return ([27] if c.isupper() else []) + [ord(c.lower()) - 96]
    if c in "0123456789":
        return [28]
    return [{".": 29, ",": 30}.get(c, 31 if ord(c) < 128 else 32 + ord(c) % 32)]


def brute_symbols(text):
    found = [0, 0, 0]
    for c in text:
        found += [s for s in symbol(c) if s or found[-1]]
    return found + [0] if found[-1] else found


class Plain:
    """Interpolated modified Kneser-Ney by its formulas, over tuples."""

    def __init__(self, texts):
        runs = [brute_symbols(t) for t in texts]
        self.counts = {4: Counter(tuple(r[i : i + 4]) for r in runs for i in range(len(r) - 3))}
        for size in (3, 2, 1):
            self.counts[size] = Counter(g[1:] for g in self.counts[size + 1])
        self.off = {}
        for size, counts in self.counts.items():
            n = Counter(counts.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
            self.off[size] = [
                max(0, i - (i + 1) * y * n[i + 1] / n[i]) if n[1] and n[2] and n[i] else i / 2 for i in (1, 2, 3)
            ]
        self.total, self.taken = defaultdict(Counter), defaultdict(Counter)
        for size, counts in self.counts.items():
            for gram, c in counts.items():
                self.total[size][gram[:-1]] += c
                self.taken[size][gram[:-1]] += self.less(size, c)

    def less(self, size, c):
        return min(c, self.off[size][min(c, 3) - 1])

    def p(self, gram):
        if not gram:
            return 1 / 64
        size, total = len(gram), self.total[len(gram)][gram[:-1]]
        if not total:
            return self.p(gram[1:])
        c = self.counts[size][gram]
        own = (c - self.less(size, c)) / total if c else 0
        return own + self.taken[size][gram[:-1]] / total * self.p(gram[1:])

    def log_perplexity(self, text):
        run = brute_symbols(text)
        grams = [tuple(run[i : i + 4]) for i in range(len(run) - 3)]
        return -sum(math.log(self.p(g)) for g in grams) / len(grams)


def corpus(seed, count=60):
    dice = random.Random(seed)
    parts = ["the ", "and ", "Ing", "tion ", "é", "ßa ", "12 ", ". ", ", ", "\n", "#", "日本", "\x1c", " "]
    return ["".join(dice.choices(parts, k=dice.randrange(1, 400))) for _ in range(count)]


def quantile(values, q):
    return float(np.quantile(values, q))


@pytest.mark.parametrize("model_bytes", [1 << 28, 4096])
def test_perplexities_and_verdicts_by_the_formulas(spark, model_bytes):
    """Whether all languages fit in a pass or a pass has one or none."""
    rows = [(i, t, ["xx", "yy", None][i % 3]) for i, t in enumerate(corpus(5, 90))] + [(None, None, "xx"), (91, " \n", "zz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    got = {r.doc_id: r for r in judge_documents(docs, reach=1.0, model_bytes=model_bytes).collect()}
    assert len(got) == len(rows)
    halves = {r.doc_id: r.h for r in docs.select("doc_id", half(F.col("text").cast("binary")).alias("h")).collect()}
    for lang in ("xx", "yy", None):
        own = [(i, t) for i, t, la in rows if la == lang and t]
        plain = [Plain([t for i, t in own if halves[i] == part]) for part in (0, 1)]
        logs = {i: plain[1 - halves[i]].log_perplexity(t) for i, t in own}
        sound = {}
        for i, t in own:
            counts = brute_counts(t)
            assert tuple(got[i][c] for c in COUNTS) == counts
            assert got[i].base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
            assert math.log(got[i].perplexity) == pytest.approx(logs[i], rel=1e-5)
            if not got[i].base_failed:
                sound[i] = logs[i]
        low, high = (quantile(list(sound.values()), q) for q in (0.25, 0.75))
        spread = max(high - low, 0.05)
        for i, value in sound.items():
            if min(abs(value - low + spread), abs(value - high - spread)) > 1e-4:
                assert got[i].kept == (low - spread <= value <= high + spread)
        assert 0 < len(sound) < len(own)
    assert got[None].perplexity is None and got[91].perplexity is None and not got[91].kept


def test_awkward_documents(spark):
    docs = awkward(spark).withColumnRenamed("Text_", "lang")
    got = judge_documents(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, *(r[c] for c in COUNTS)) for r in got) == sorted(
        (i is None, i or 0, *brute_counts(t or "")) for i, t in ROWS
    )
    assert not any(r.kept for r in got)  # short, or the same words over and over
    assert judge_documents(empty(spark).withColumnRenamed("Text_", "lang")).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_counts_by_the_definition(seed, monkeypatch):
    monkeypatch.setattr(quality_rules, "SLICE", 50)
    for text in [*corpus(seed), "a b c a b c", "a b c d", "x x x x", " \n \n", "a\n\na\n a\na", "#" * 500]:
        assert plain_counts(text.encode()) == brute_counts(text)
        run = brute_symbols(text)
        grams = np.concatenate(list(four_grams(text.encode())) or [np.empty(0, int)])
        assert grams.tolist() == [((run[i] * 64 + run[i + 1]) * 64 + run[i + 2]) * 64 + run[i + 3] for i in range(len(run) - 3)]


def test_unknown_n_grams_back_off():
    """Of another text than those counted: the context's weight times the shorter n-gram."""
    def hashes(values):
        return SortedHashes(np.array(list(values)), np.array(list(values.values())))

    model = LanguageModel(hashes({64 + 5: math.log(0.25)}), hashes({1: math.log(0.5), 64 + 3: math.log(0.1)}))
    gram = ((7 * 64 + 7) * 64 + 3) * 64
    assert np.exp(model.logs(np.array([gram + 5, gram + 6]))) == pytest.approx([0.1 * 0.25, 0.1 * 0.5 / 64])
    assert log_perplexity(UNTRAINED, b"x") == pytest.approx(math.log(64))
    assert log_perplexity(UNTRAINED, b"") is None


def test_noise_goes_and_prose_stays(spark, small):
    docs = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/documents.parquet")
    dice = random.Random(1)
    noise = [(-i, " ".join("".join(dice.choices("qxzjkvwQXZ$0{}", k=6)) for _ in range(80)), "en") for i in range(1, 4)]
    same = [(-9, " ".join(f"aaaaaaaaaaaa{'a' * i}" for i in range(80)), "en")]
    planted = spark.createDataFrame(noise + same, "doc_id bigint, text string, lang string")
    got = judge_documents(docs.select("doc_id", "text", "lang").unionByName(planted))
    labels = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/labels.parquet")
    assert got.filter("doc_id < 0 AND kept").count() == 0
    assert got.filter("doc_id < 0 AND base_failed").count() == 0
    good = got.join(labels, "doc_id").filter("quality = 1 AND NOT base_failed").selectExpr("avg(int(kept))").first()[0]
    assert good > 0.98  # the others hold a passage in another language
