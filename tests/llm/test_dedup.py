"""Deduplication operators against brute force on small tables with nulls, empty texts, repeats and hot groups."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from dockgrid.llm.common import grams, hash_words
from dockgrid.llm.exact_dedup import cuts, exact_dedup
from dockgrid.llm.line_dedup import _streamed, line_dedup
from dockgrid.llm import near_dup
from dockgrid.llm.near_dup import PartEnum, near_duplicates
from dockgrid.llm.substring_dedup import repeated_windows, substring_dedup

DOCS = "doc_id long, text string, n_lines string, _n int, h1 string, rep int"


def frame(spark, texts, ids=None):
    rows = [(i, t, "x", 1, "y", 2) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)] + ["É", "Ünï", "漢字"]
    passage = " ".join(rng.choice(vocab) for _ in range(70))
    base = [" ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 40, 120, 400]))) for _ in range(n)]
    out = []
    for k, t in enumerate(base):
        words = t.split()
        if k % 3 == 0:
            words[len(words) // 2 : len(words) // 2] = passage.split()
        if k % 5 == 0:
            words = base[0].split()
            words[rng.randrange(len(words))] = "changed"
        if k % 7 == 0:
            words = base[1].split()
        sep = rng.choice([" ", "\n", "\t ", " \r\n"])
        out.append(sep.join(words).replace("w7", "W7"))
    return [None, "", " \n ", "a b", *out, base[1], base[1], base[1].upper()]


def test_word_hashes_and_grams():
    texts = [b"a bb  a\n", b"", b"x" * 5000 + b" y", b"a bb a"]
    h, _, _, first, _ = hash_words(texts)
    words = [x.split() for x in texts]
    assert [first[k + 1] - first[k] for k in range(4)] == [len(w) for w in words]
    assert len({int(x) for x in h}) == len({w for ws in words for w in ws})
    for n in (1, 2, 3, 5, 8, 25):
        x = np.array([k % 7 for k in range(60)], np.uint64)
        g = grams(x, n)
        seen = {}
        for k in range(60 - n + 1):
            assert seen.setdefault(tuple(x[k : k + n].tolist()), int(g[k])) == int(g[k])
        assert len(set(seen.values())) == len(seen)


def test_cuts_are_content_defined():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 60_000, dtype=np.uint8).tobytes()
    a, b = cuts(data), cuts(b"some new beginning" + data)
    parts = lambda d, e: {d[x:y] for x, y in zip([0, *e], e, strict=False)}
    assert a[-1] == len(data) and len(a) > 5
    assert len(parts(data, a) & parts(b"some new beginning" + data, b)) >= len(a) - 2
    assert max(y - x for x, y in zip([0, *a], a, strict=False)) <= 16384


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_dedup(spark, bits):
    rng = random.Random(5)
    long_ = "".join(rng.choice("abcdef ") for _ in range(30_000))
    texts = [*corpus(), long_, long_, long_[:-1] + "z", None]
    got = {r["doc_id"]: r for r in exact_dedup(frame(spark, texts), bits).collect()}
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    assert len(got) == len(texts)
    for t, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(ids), len(ids), i == max(ids), sha(t))


def test_exact_dedup_of_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (3, "b"), (3, "b")], "doc_id long, text string")
    rows = exact_dedup(df).collect()
    assert sorted((r["keep_id"] or -1, r["kept"]) for r in rows) == [(-1, False), (-1, False), (3, False), (3, True)]
    assert exact_dedup(df.limit(0)).count() == 0


def lines_brute(texts):
    key = lambda x: re.sub(r"[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    where = defaultdict(set)
    for i, t in enumerate(texts):
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                where[key(line)].add(i)
    out = {}
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(where.get(key(x), ())) > 1 and min(where[key(x)]) < i)]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def test_line_dedup(spark):
    rng = random.Random(2)
    pool = ["a common line of text", "  A COMMON line of text \t", "short", "", "É long line with accents", "é long line with accents", *[f"line number {k} here" for k in range(30)]]
    texts = [None, "", *["\n".join(rng.choice(pool) for _ in range(rng.choice([1, 4, 9, 200]))) for _ in range(50)], "a common line of text\n\na common line of text"]
    want = lines_brute(texts)
    got = line_dedup(frame(spark, texts))
    assert {"h1", "_n", "rep"} <= set(got.columns)
    for r in got.collect():
        assert (r["text"], r["n_lines"], r["n_dropped"]) == want[r["doc_id"]]
        gone = sum(64 - bin(v & (1 << 64) - 1).count("1") for v in (r["keep_bits"] or {}).values())
        assert gone == r["n_dropped"]
    assert line_dedup(frame(spark, ["x"]).limit(0)).count() == 0


def test_a_line_in_every_document_is_one_range_exchange(spark):
    texts = [f"the line that every document holds\nown line number {k}\n{'y ' * 40_000 if k == 3 else ''}" for k in range(400)]
    want = lines_brute(texts)
    for r in line_dedup(frame(spark, texts)).collect():
        assert (r["text"], r["n_lines"], r["n_dropped"]) == want[r["doc_id"]]
    lines = spark.range(5000).selectExpr("id % 7 AS h1", "id % 3 AS h2", "id AS doc_id", "0L AS text_key", "0 AS pos")
    common = spark.createDataFrame([(1, 1)], "h1 long, h2 long")
    streamed = _streamed(lines, common, 4)
    plan = streamed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in plan and "hashpartitioning(h1" not in plan
    blocks = {(r["h1"], r["h2"], r["block"]) for r in streamed.collect()}
    assert len([x for x in blocks if x[:2] == (1, 1)]) == 4 and len(blocks) == 20 + 4


def test_line_dedup_of_null_and_repeated_ids(spark):
    text = "a line of some length\nanother line of some length"
    df = spark.createDataFrame([(None, text, 1), (4, text, 2), (4, "another line of some length\nx", 3), (9, text, 4)], "doc_id long, text string, n_dropped int")
    got = sorted(((r["doc_id"] or -1), r["text"], r["n_dropped"]) for r in line_dedup(df).collect())
    assert got == [(-1, text, 0), (4, text, 0), (4, "another line of some length\nx", 0), (9, "", 2)] or got == sorted([(-1, text, 0), (4, text, 0), (4, "another line of some length\nx", 0), (9, "", 2)])


def windows_brute(texts, n):
    first = {}
    words = [(t or "").split() for t in texts]  # Python's str.split also splits elsewhere, but not in these texts
    for i, w in enumerate(words):
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k : k + n]), i)
    out = {}
    for i, w in enumerate(words):
        gone = {k + j for k in range(len(w) - n + 1) if first[tuple(w[k : k + n])] < i for j in range(n)}
        out[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("n", [10, 50])
def test_substring_dedup(spark, n):
    texts = [*corpus(), "to " * 300, "to " * 200, " ".join(f"v{k % 60}" for k in range(400)), " ".join(f"v{k % 60}" for k in range(30, 300))]
    want = windows_brute(texts, n)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup(frame(spark, texts), n).collect()}
    assert got == want
    assert substring_dedup(frame(spark, ["x"]).limit(0), n).count() == 0


def test_substring_dedup_of_null_and_repeated_ids(spark):
    w = [f"v{k}" for k in range(80)]
    long_, short = " ".join(w), "some words"
    df = spark.createDataFrame([(7, long_), (7, short), (7, long_), (3, " ".join(w[:60])), (None, long_), (9, "x " + long_)], "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1), r["n_words"], r["n_removed"]) for r in substring_dedup(df).collect())
    assert got == [(-1, 80, 0), (3, 60, 0), (7, 2, 0), (7, 80, 60), (7, 80, 60), (9, 81, 80)]


def test_windows_double_until_none_repeats(spark):
    text = " ".join(f"v{k}" for k in range(500))
    got = repeated_windows(frame(spark, [text, "z z " + text]), 50, grow=True).collect()
    places = defaultdict(list)
    for r in got:
        places[r["doc_id"], r["length"]] += range(r["s"], r["e"])
    assert {k: sorted(x) for k, x in places.items()} == {(1, n): list(range(2, 503 - n)) for n in (50, 100, 200, 400)}


def classes_brute(texts, n=5, percent=80):
    sets = []
    for t in texts:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()})
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return {i: (len(s), label[i]) for i, s in enumerate(sets)}


@pytest.mark.parametrize("parts", [(2, 1), (3, 2)])
def test_near_duplicates(spark, parts):
    rng = random.Random(9)
    vocab = [f"w{k}" for k in range(3000)]
    texts = corpus(4)
    for size in (6, 9, 30, 75, 90, 160, 300, 900):
        base = [rng.choice(vocab) for _ in range(size)]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, size // 40 + 1])):
                w[rng.randrange(size)] = rng.choice(vocab)
            texts.append(" ".join(w[: size - rng.choice([0, 0, size // 12, size // 6])]))
    want = classes_brute(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(frame(spark, texts), parts=parts).collect()}
    assert got == want


def test_near_duplicates_of_empty_table_and_repeated_rows(spark):
    assert near_duplicates(frame(spark, ["x"]).limit(0)).count() == 0
    got = near_duplicates(spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None)], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == [(1, 2, 1), (1, 2, 1), (2, 0, 2)]


def test_near_duplicates_of_rows_that_share_a_doc_id(spark):
    words = [f"w{k}" for k in range(30)]
    a, b, c = " ".join(words), " ".join([*words[:-1], "z"]), "quite another text of some words here"
    df = spark.createDataFrame([(2, a), (2, c), (5, b), (7, c)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["stays"]) for r in near_duplicates(df).collect())
    assert got == [(2, 3, 2, True), (2, 26, 2, True), (5, 26, 2, False), (7, 3, 2, False)]


def families(m):
    """Two families of m near copies: the second differs from the first by one passage that its members share."""
    rng = random.Random(8)
    base = [f"b{k}" for k in range(300)]
    other = base[:120] + [f"p{k}" for k in range(60)] + base[180:]
    out = []
    for k in range(m):
        for words in (base, other):
            w = list(words)
            w[rng.choice([*range(10, 110), *range(190, 290)])] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(w))
    return out


def test_families_do_not_meet_in_squares(spark, monkeypatch):
    met = []
    whole = near_dup._meetings

    def counted(cut, percent):
        out = whole(cut, percent)
        met.append(out.count())
        return out

    monkeypatch.setattr(near_dup, "_meetings", counted)
    for m in (20, 40):
        texts = families(m)
        got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(spark, texts)).collect()}
        assert got == {i: label for i, (_, label) in classes_brute(texts).items()}
    assert met[1] <= 3 * met[0] + 50 and met[1] < 40 * 40 // 2


def test_bound_on_differing_shingles():
    method = PartEnum(80, (2, 1))
    for n in range(1, 200):
        most = 0
        for m in range(-(-80 * n // 100), 100 * n // 80 + 1):
            least_common = next(c for c in range(min(n, m) + 1) if 100 * c >= 80 * (n + m - c)) if 100 * min(n, m) >= 80 * max(n, m) else None
            if least_common is not None:
                most = max(most, n + m - 2 * least_common)
        assert method.differ(n) >= most


@pytest.mark.parametrize("parts", [(3, 2), (2, 1), (4, 2)])
def test_sets_that_link_share_as_many_signatures_as_the_bound_says(parts):
    method, rng = PartEnum(80, parts), np.random.default_rng(5)
    for n in (1, 4, 9, 30, 63, 64, 100, 158, 159, 255, 300, 511, 639, 1200):
        for _ in range(20):
            x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            gone = int(rng.integers(0, n // 5 + 1))
            more = int((n - gone) / 0.8 - n)  # the most shingles of its own that a partner may have
            y = np.concatenate((x[gone:], rng.integers(0, 1 << 63, more, dtype=np.uint64)))
            assert 100 * (n - gone) >= 80 * (n + more)
            mine, other = ({code: (t, set(sigs.tolist())) for code, t, sigs in method.units(np.sort(s))} for s in (x, y))
            both = {code: (mine[code][1] & other[code][1], (mine[code][0], other[code][0])) for code in mine.keys() & other.keys()}
            assert any(len(shared) >= max(t) for shared, t in both.values()), (n, gone, more)
            # A T of 1 may stand for less: such sets are also looked for by their single shingles.
            assert all(len(shared) >= max(t) for shared, t in both.values() if min(t) > 1)


@pytest.mark.parametrize("n", [65, 1024, 4096])
def test_long_words_that_polynomials_cannot_tell_apart(spark, n):
    """Thue-Morse words and their complements have equal polynomial hashes modulo a power of two."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(n))
    other = word.translate(str.maketrans("ab", "ba"))
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join([*words[:30], x, *words[30:]]) for x in (word, other, word)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["n_removed"] for r in substring_dedup(df).orderBy("doc_id").collect()] == [0, 0, 61]
    few = spark.createDataFrame([(k, " ".join([x] * 9)) for k, x in enumerate((word, other, word))], "doc_id long, text string")
    assert [r["component_id"] for r in near_duplicates(few).orderBy("doc_id").collect()] == [0, 1, 0]


def test_sets_probe_only_where_another_label_is_indexed(spark, monkeypatch):
    """1 and 2 may link; 3 and 4 share some shingles, enough to probe and too few to be indexed, so none of theirs is a row."""
    sets = {1: [*range(100, 120), *range(200, 210)], 2: [*range(100, 120), *range(300, 310)], 3: [*range(500, 530), *range(600, 620)], 4: [*range(500, 530), *range(700, 720)]}
    linked = spark.createDataFrame([(0, d, False, 100, 100, e) for d, e in sets.items()], "hub long, doc_id long, linked boolean, hub_n int, n int, e array<long>")
    comp = spark.createDataFrame([], "node long, label long")
    cuts, meetings = [], near_dup._meetings
    monkeypatch.setattr(near_dup, "_meetings", lambda cut, percent: cuts.append(cut) or meetings(cut, percent))
    assert [tuple(r) for r in near_dup._apart(linked, comp, 80).collect()] == [(1, 2)]
    assert {r["doc_id"] for r in cuts[0].collect()} == {1, 2}
