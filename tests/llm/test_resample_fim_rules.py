"""Importance resampling, fill-in-middle and repetition rules against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from dockgrid.llm import resample
from dockgrid.llm.fill_middle import Cutter, Fenwick, fill_in_middle, restored
from dockgrid.llm.repetition import COVERAGE, LINES, SYMBOLS, measure, quality_rules
from dockgrid.llm.resample import cutoff, features, importance_resample

TEXTS = [None, "", " \n\t", "a", "\n", "one\ntwo\n\nthree", "ends\n", "<P> inside\nx", "é漢😀\n" * 3 + "z", "a b c d e " * 40, "Same line here\nother words\nSame line here\nSame line here \n", "x" * 5000 + "\ny\n" + "w v\n" * 3000, "A-b,C d\x0bE\x85f ＃", "# ## $$ | |||\n<a> <b>", "to be or not to be that is the question " * 2]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(k if k != 3 else None, t, "clash", 1) for k, t in enumerate(texts)] + [(7, texts[-1], "again", 2), (7, texts[-1], "again", 2)], "doc_id long, text string, score string, rank int")


# ---- fill-in-middle


def brute_fim(doc, text, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return doc, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("fim", "spm", "block"), [(100, 50, 4096), (60, 0, 3), (100, 100, 1)])
def test_fill_in_middle_is_brute_force(spark, fim, spm, block):
    df = docs(spark)
    key = lambda r: repr(r)
    got = fill_in_middle(df, fim_percent=fim, spm_percent=spm, block=block).withColumn("back", restored()).collect()
    want = [brute_fim(r["doc_id"], r["text"], fim, spm) for r in df.collect()]
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    assert sorted(r["back"] for r in got) == sorted(r["text"] or "" for r in df.collect())
    assert fill_in_middle(df.limit(0)).count() == 0


def test_cuts_at_every_unit():
    for text in ("", "a", "\n\n\n", "one\ntwo\nthree", "é\n漢字\n😀x\n" * 30):
        for block in (1, 2, 7, 4096):
            cutter, units = Cutter(text.encode(), block), re.findall(r"[^\n]*\n|[^\n]+", text)
            assert cutter.n == len(units)
            for k in range(len(units) + 1):
                head = "".join(units[:k])
                assert cutter.cut(k) == (len(head.encode()), len(head))


def test_fenwick_descends_to_the_block():
    counts = np.array([[random.Random(k).choice([0, 0, 1, 5]), k] for k in range(77)])
    tree, ends = Fenwick(counts), np.cumsum(counts[:, 0])
    for k in range(1, int(ends[-1]) + 1):
        at = int(np.searchsorted(ends, k))
        assert tree.descend(k) == (at, int(counts[:at, 0].sum()), int(counts[:at, 1].sum()))


def test_marks_that_could_arise_are_refused(spark):
    for marks in (("<P>", "<P>", "<M>"), ("<P<", "<S>", "<M>"), ("", "<S>", "<M>"), ("ab", "xa", "<M>")):
        with pytest.raises(ValueError, match="mark"):
            fill_in_middle(docs(spark), marks=marks)


# ---- repetition


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)

    def covered(n):
        windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        twice = [i for i, w in enumerate(windows) if windows.count(w) > 1]
        return sorted({i + k for i in twice for k in range(n)})

    lines = text.split("\n")
    again = [x for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i]]
    chars = sum(map(len, words))
    dup = sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x in again)
    symbols, repeat = len(re.findall(r"[#*$%&|<>]", text)), len(covered(5))
    failed = len(words) < 10 or 100 * repeat > 20 * len(words)
    ok = 100 * dup <= LINES * chars and 100 * symbols <= SYMBOLS * len(words) and all(100 * sum(len(words[i]) for i in covered(n)) <= most * chars for n, most in COVERAGE.items())
    return len(words), chars, symbols, len(again), repeat, dup, failed, not failed and ok


def test_rules_are_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [rng.choice("abcdé漢|") * rng.randint(1, 4) for _ in range(60)]
    texts = [t for t in TEXTS if len(t or "") < 6000] + ["".join(w + rng.choice("  \n") for w in rng.choices(vocabulary[: rng.randint(4, 60)], k=rng.randint(8, 200))) for _ in range(60)]
    texts += [f"{' '.join(f'word{k}' for k in range(40))} {x}" for x in ("one two three four five six " * 2, "one two three " * 4, "### ## #")]
    df = docs(spark, texts)
    got = quality_rules(df).drop("covered").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r["doc_id"], *brute_rules(r["text"])) for r in df.collect()), key=repr)
    assert {True, False} == {r["kept"] for r in got if not r["base_failed"]}
    assert quality_rules(df.limit(0)).count() == 0


def test_texts_of_a_batch_do_not_meet():
    one = b"a b c d e f g h i j k l"
    assert not measure([one, one, b"", one], (3, 5), 5)["n_repeat_words"].any()


def test_long_words_of_equal_polynomials_are_different():
    """Words over two letters that polynomial hashes modulo a power of two can't tell apart."""
    for n in (1024, 4096):
        word = "".join("ab"[bin(k).count("1") % 2] for k in range(n))
        other = word.translate(str.maketrans("ab", "ba"))
        got = measure([f"x {word} y z u v x {other} y z u".encode()], (5,), 5)
        assert got["n_repeat_words"][0] == 0


# ---- importance resampling


def brute_features(text, longest=2):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute_resample(rows, target, percent, least, buckets, seed=7):
    counts = []
    for texts in ([t for _, t in rows], target):
        c = [0] * buckets
        for f in itertools.chain.from_iterable(brute_features(t)[1] for t in texts):
            c[zlib.crc32(f.encode()) % buckets] += 1
        counts.append(c)
    s, t = counts
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for doc, text in rows:
        words, feats = brute_features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in feats) // max(len(feats), 1)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(words), len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], math.inf if x[0] is None else x[0]))
    for k, x in enumerate(may[: percent * len(may) // 100]):
        x[5] = k + 1
    return sorted(map(tuple, out), key=repr)


def test_resampling_is_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["Alpha", "beta", "gamma-x", "é", "漢字", "42", "w" * 130, "delta"]
    rows = [(k if k % 19 else None, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for k in range(1, 400)] + [(900 + k, t) for k, t in enumerate(TEXTS)] + [(7, "beta " * 30)] * 5
    target = ["beta beta gamma", None, "42 delta é " * 9]
    df = spark.createDataFrame([(d, t, 1.5) for d, t in rows], "doc_id long, text string, weight double").repartition(7)
    got = importance_resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent=40, least_words=5, buckets=64, enough=8)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resample(rows, target, 40, 5, 64)


def test_resampling_of_nothing(spark):
    df = docs(spark)
    none = spark.createDataFrame([], "text string")
    assert importance_resample(df.limit(0), none).count() == 0
    got = importance_resample(df, none, least_words=1).collect()
    assert len(got) == df.count() and sum(r["rank"] is not None for r in got) == 25 * sum(r["n_words"] > 0 for r in got) // 100
    assert all(r["rank"] is None for r in importance_resample(df, none, least_words=10**6).collect())


def test_cutoff_is_the_place_sought(spark):
    rng = random.Random(5)
    keys = [(rng.choice([-5, 0, 0, 0, 3, k]), rng.randint(0, 3), k) for k in range(800)]
    df = spark.createDataFrame(keys, "a long, b long, c long").repartitionByRange(5, "c")
    keys.sort()
    for draw in (1, 201, 800):
        assert cutoff(df, draw, enough=8) == keys[draw - 1]
    assert cutoff(df, 0) is None and cutoff(df, 801) is None


def test_medians_come_with_their_sizes():
    import pyarrow as pa

    x = np.array([(k % 5, k % 3, k) for k in range(101)])
    batches = [pa.RecordBatch.from_arrays([pa.array(x[a:b, c]) for c in range(3)], names=["a", "b", "c"]) for a, b in ((0, 40), (40, 40), (40, 101))]
    (got,) = resample._median(iter(batches))
    assert [c[0].as_py() for c in got.columns] == [101, *sorted(map(tuple, x.tolist()))[50]]
    assert not list(resample._median(iter([])))


def test_features_of_long_words_and_borders():
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab é漢 -.Z9") * rng.choice([1, 1, 1, 70]) for _ in range(rng.randint(0, 40))) for _ in range(50)]
    first, found = features([t.encode() for t in texts], 3, 10_000)
    for k, t in enumerate(texts):
        words, feats = brute_features(t, 3)
        assert first[k + 1] - first[k] == len(words)
        got = sorted(int(x) for n in found for x in n[first[k] : first[k + 1]] if x >= 0)
        assert got == sorted(zlib.crc32(f.encode()) % 10_000 for f in feats)
