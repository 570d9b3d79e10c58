"""Token counts, codec, decontamination, classifiers, chat and pipeline on small tables."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import corpus_pipeline
from dockgrid.llm.chat import perspectives
from dockgrid.llm.decontaminate import contamination, decontaminate
from dockgrid.llm.language import CHUNK, WORD, Crf, fit_language, languages, marginals
from dockgrid.llm.quality import Compression, fit_quality, logistic, quality_scores
from dockgrid.llm.sentencepiece_codec import Codec, sentencepiece
from dockgrid.llm.token_counts import chunk_ids, token_counts

WORDS = str(public_tokenizers.path("word_bpe_49k.json"))
PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"
ODD = ["", " ", "don't isn't  x", "<|endoftext|>a <|startoftext|>", "é é ́ 漢字 😀", "a b c\x85d", "x" * 3000, "ab " * 2000, "1234 56,7.8!!! --\n\n\tq", "AbC " * 50 + "y" * 700 + " end"]


def test_token_counts_match_the_library(spark):
    t = Tokenizer.from_file(WORDS)
    texts = [None, *ODD]
    df = spark.createDataFrame([(k, x, 5) for k, x in enumerate(texts)], "doc_id long, text string, n_tokens int")
    for chunk, overlap in ((32768, 512), (200, 8)):
        got = {r["doc_id"]: r for r in token_counts(df, WORDS, 100, chunk, overlap).collect()}
        for k, x in enumerate(texts):
            n = len(t.encode(x or "", add_special_tokens=False).ids)
            assert (got[k]["n_tokens"], got[k]["n_bytes"], got[k]["over_limit"]) == (n, len((x or "").encode()), n > 100)
    assert token_counts(df.limit(0), WORDS).count() == 0


def test_spliced_chunks_are_the_whole():
    t = Tokenizer.from_file(WORDS)

    def encode(part):
        e = t.encode(part, add_special_tokens=False)
        return e.ids, [a for a, _ in e.offsets]

    for x in ODD:
        pieces = list(chunk_ids(encode, x, 50, 4))
        assert [i for p in pieces for i in p] == t.encode(x, add_special_tokens=False).ids
    assert len(list(chunk_ids(encode, "ab " * 2000, 50, 4))) > 50


def test_codec_is_the_library(spark):
    sp, codec = SentencePieceProcessor(model_file=PIECES), Codec.load(PIECES)
    rng = random.Random(4)
    texts = [*ODD, "".join(rng.choice("etaoin shrdlu,.é\n") for _ in range(4000)), "abcabc" * 500, " " * 300, "<0x0A> <s> <unk>", "a▁b"]
    for x in texts:
        ids = sp.encode(x)
        assert codec.encode(x) == ids
        assert codec.decode(ids) == sp.decode(ids)
    df = spark.createDataFrame([(k, x) for k, x in enumerate([None, *texts])], "doc_id long, text string")
    for r in sentencepiece(df, PIECES).collect():
        x = [None, *texts][r["doc_id"]] or ""
        assert list(r["ids"]) == sp.encode(x) and r["n_ids"] == len(r["ids"]) and r["round_trip"] == (x.replace("▁", " ") == x)
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(sp.encode(x)).encode()).hexdigest()


def test_codec_commits_within_its_window():
    codec = Codec.load(PIECES)
    text = "abcdefgh no " * 400
    whole, (first, *rest) = codec.encode(text), list(codec.stream(text, 64))
    assert len(rest) > 50 and len(first) < 60  # ids come before the text's end is reached
    assert [int(i) for x in (first, *rest) for i in x] == whole == SentencePieceProcessor(model_file=PIECES).encode(text)


@pytest.mark.parametrize("unit", ["a", "=", " ", "ab", "the internationalization of ==== "])
def test_codec_window_stays_as_wide_as_a_block_and_a_piece(unit):
    """Pieces overlap all along in runs of one letter; ids are committed where the open paths meet all the same."""
    codec, text, seen = Codec.load(PIECES), unit * (200_000 // len(unit)), []
    got = [int(i) for part in codec.stream(text, watch=lambda looked_at, held: seen.append((looked_at, held))) for i in part]
    assert got == SentencePieceProcessor(model_file=PIECES).encode(text)
    assert len(seen) >= 12 and max(n for n, _ in seen) <= codec.BLOCK + codec.longest and max(n for _, n in seen) <= codec.BLOCK + 4 * codec.longest


def test_paths_that_never_meet_are_set_aside():
    """Of two paths that go on for ever nothing is committed; they are followed back no further than where they came through before."""
    codec = Codec.load(PIECES)
    held = [(0, np.zeros(100, np.int32), [2 if k else 1 for k in range(100)]), (100, np.zeros(100, np.int32), [2] * 100)]
    came = [set(), set()]
    assert codec.met(held, came, 200) == 0 and came[1] == {99, 100}
    held.append((200, np.zeros(100, np.int32), [2] * 100))
    came.append(set())
    assert codec.met(held, came, 300) == 0 and came == [set(), {99, 100}, {199, 200}]


def test_codec_windows_and_long_stretches():
    sp, codec = SentencePieceProcessor(model_file=PIECES), Codec.load(PIECES)
    rng = random.Random(6)
    parts = ["a", "b", "aa", "ab", "  ", " ", "\n", "the", "ing", "é", "漢", "字", "🙂", "0", "==", "--", "▁", "\0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 5, 20, 80]))) for _ in range(2000)]
    texts += ["a" * 3000, "ab" * 2000, "=" * 1000, "0123456789abcdef" * 300, "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(2000))]
    want = sp.encode(texts)
    for window in (None, 64, 300):
        assert [x.tolist() for x in codec.encode_all(texts, window)] == want


def test_repeated_null_and_clashing_rows_of_token_operators(spark):
    df = spark.createDataFrame([(1, "a b", 1, 2, 3), (1, "a b", 1, 2, 3), (1, "c", 1, 2, 3), (None, None, 1, 2, 3)], "doc_id long, text string, ids int, n_tokens int, n_bytes int")
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in token_counts(df, WORDS).collect()) == [(-1, 0, 0), (1, 1, 1), (1, 3, 2), (1, 3, 2)]
    assert sorted((r["doc_id"] or -1, r["n_ids"]) for r in sentencepiece(df, PIECES).collect()) == [(-1, 0), (1, 1), (1, 2), (1, 2)]
    assert sentencepiece(df.limit(0), PIECES).count() == 0


def norm(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def hits_brute(doc, items, window):
    words, hit, found = norm(doc), set(), set()
    for name, text in items:
        w = norm(text)
        n = min(window, len(w))
        grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
        for k in range(len(words) - n + 1):
            if n and tuple(words[k : k + n]) in grams:
                hit |= set(range(k, k + n))
                found.add(str(name))
    return len(words), hit, found


@pytest.mark.parametrize("shard", [1_000_000, 30])
def test_contamination(spark, shard):
    rng = random.Random(8)
    vocab = ["a", "b", "c", "É", "d1", "e"]
    items = [(1, " ".join(rng.choice(vocab) for _ in range(25))), (2, "A, b! C"), (3, None), (4, "..."), (10, " ".join(rng.choice(vocab) for _ in range(14))), (11, "d1")]
    docs = [None, "", "a b c", "d1"] + ["x " * rng.randrange(9) + " ".join(rng.choice(vocab[:4]) for _ in range(80)) + " " + items[0][1][rng.randrange(20) :] + " q" for _ in range(25)]
    got = contamination(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=6, shard_words=shard)
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, hit, found = hits_brute(docs[r["doc_id"]], items, 6)
        spans = set()
        for a, b in zip(r["hits"][::2], r["hits"][1::2], strict=True):
            spans |= set(range(a, b))
        assert (r["n_words"], spans, list(r["items"])) == (n, hit, sorted(found))


def test_contamination_of_empty_tables_long_texts_and_repeats(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k", 0)], "item_id long, text string, n_words int")
    docs = spark.createDataFrame([(1, "x " * 200_000 + "a b c d e f g h i j", "s"), (1, "clean", "s"), (1, "clean", "s"), (None, None, "s")], "doc_id long, text string, hits string")
    got = sorted((r["doc_id"] or -1, r["n_words"], list(r["hits"])) for r in contamination(docs, bench).collect())
    assert got == [(-1, 0, []), (1, 1, []), (1, 1, []), (1, 200_010, [200_000, 200_010])]
    assert contamination(docs.limit(0), bench).count() == 0 and decontaminate(docs.limit(0), bench).count() == 0
    assert {tuple(r["hits"]) for r in contamination(docs, bench.limit(0)).collect()} == {()} and decontaminate(docs, bench.limit(0)).count() == 4
    # Equal words over and over: their ancestors are stored, not climbed to.
    same = spark.createDataFrame([(2, "w " * 3000)], "item_id long, text string")
    assert contamination(spark.createDataFrame([(1, "w " * 5000)], "doc_id long, text string"), same).first()["hits"] == [0, 5000]


def test_decontaminate_cuts_passages(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Keep this. One, two three four five six seven eight nine ten eleven! And this stays here with some more words to keep it", "s"), (2, item, "s"), (3, None, "s"), (4, "clean text", "s")]
    got = {r["doc_id"]: r["text"] for r in decontaminate(spark.createDataFrame(docs, "doc_id long, text string, item_id string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got == {1: "Keep this. ! And this stays here with some more words to keep it", 3: None, 4: "clean text"}


@pytest.mark.parametrize("most", [1_000_000, 30])
def test_decontaminate_takes_all_shards(spark, most):
    rng = random.Random(9)
    vocab = ["a", "b", "c", "É", "d1", "e"]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(25))) for k in range(4)] + [(9, "A, b! C"), (10, None)]
    texts = [None, "", "a b c", *(" ".join(rng.choice(vocab[:4]) for _ in range(30)) + f" q {items[k % 4][1]} q {items[(k + 1) % 4][1][: 30 * (k % 3)]} " + "x " * rng.randrange(90) for k in range(20))]
    docs = [*((k, x, "s") for k, x in enumerate(texts)), (5, texts[6], "again"), (6, texts[6], "copy"), (None, texts[7], "s"), (None, texts[8], "s"), (None, None, "s")]
    got = decontaminate(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame(items, "item_id long, text string"), window=6, shard_words=most).collect()
    want = []
    for i, x, source in docs:
        n, hit, _ = hits_brute(x, items, 6)
        if len(hit) <= 0.5 * n:
            want.append((i, [w for k, w in enumerate(norm(x)) if k not in hit], source, x is None))
    assert 0 < len(want) < len(docs)
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], norm(r["text"]), r["source"], r["text"] is None)) for r in got)


def test_forward_backward_is_exhaustive():
    rng = np.random.default_rng(2)
    emit, moves = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    starts, size = np.array([0, 4, 5]), np.array([4, 1, 4])
    got = marginals(emit, moves, starts, size)
    from itertools import product

    for s, n in zip(starts, size, strict=True):
        want = np.zeros((n, 3))
        for path in product(range(3), repeat=int(n)):
            p = np.exp(sum(emit[s + k, y] for k, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
            for k, y in enumerate(path):
                want[k, y] += p
        assert np.allclose(got[s : s + n], want / want.sum(axis=1, keepdims=True))


def test_messages_pass_the_borders_of_chunks():
    rng = np.random.default_rng(5)
    size = np.array([1, 30, 5, 7, 8, 100])
    starts = np.cumsum(size) - size
    emit, moves = 3 * rng.normal(size=(int(size.sum()), 4)), rng.normal(size=(4, 4))
    for chunk in (2, 7, 50):
        assert np.allclose(marginals(emit, moves, starts, size), marginals(emit, moves, starts, size, chunk=chunk), atol=1e-12)


def test_scores_and_word_labels_against_single_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_language(docs, sample=40)
    some = docs.orderBy("doc_id").limit(30).withColumn("score", F.lit("old")).withColumn("lang_pred", F.lit(1))
    for r in languages(some, model, with_runs=True).collect():
        # Forward and backward passes over each line, word by word, on probabilities.
        total, labels = np.zeros(len(model.langs)), []
        for line in r["text"].split("\n"):
            e = np.exp(np.array([model.emissions([w])[0] for w in WORD.findall(line)]))
            a, f, b = np.exp(model.moves), [], []
            for x in e:
                f.append((f[-1] @ a if f else 1) * x)
                f[-1] = f[-1] / f[-1].sum()
            for x in e[::-1]:
                b.append(a @ (b[-1] * last) if b else np.ones(len(a)))
                b[-1], last = b[-1] / b[-1].sum(), x
            for x, y in zip(f, b[::-1], strict=True):
                total += x * y / (x * y).sum()
                labels.append(int((x * y).argmax()))
        if labels:
            assert r["lang_pred"] == model.langs[total.argmax()] and abs(r["score"] - total.max() / total.sum()) < 1e-9
            assert [model.langs[k] for k in labels] == [x["lang"] for x in r["word_langs"] for _ in range(x["s"], x["e"])]
    mixed = spark.createDataFrame([(None, docs.filter("lang = 'en'").first()["text"]), (1, ""), (1, None)], "doc_id long, text string")
    assert languages(mixed, model).count() == 3 and languages(mixed.limit(0), model).count() == 0


def test_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_language(docs.filter("doc_id % 3 <> 1"), sample=40)
    got = {r["doc_id"]: r for r in languages(docs, model).collect()}
    held = [r for r in docs.collect() if r["doc_id"] % 3 == 1]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.9
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 ... 4"), (4, "the " * (3 * CHUNK))], "doc_id long, text string")
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in languages(odd, model).collect()}
    assert [out[k] for k in (1, 2, 3)] == [("und", 0.0)] * 3 and out[4][0] == "en" and 0 <= out[4][1] <= 1
    none = fit_language(odd.selectExpr("*", "cast(null as string) AS lang"))
    assert isinstance(none, Crf) and {r["lang_pred"] for r in languages(odd, none).collect()} == {"und"}


def test_quality(spark):
    rng = random.Random(3)
    good = [" ".join(rng.choice(["the", "rain", "fell", "over", "green", "hills", "and", "rivers"]) for _ in range(80)) for _ in range(120)]
    bad = [" ".join(rng.choice(["BUY!!", "now$$", "###", "click@@", "%%%"]) for _ in range(80)) for _ in range(60)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*good, *bad])] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 120)) for k in range(180) if k % 4] + [(901, None), (None, 1)], "doc_id long, quality int")
    model = fit_quality(docs, labels)
    s = {r["doc_id"]: r["score"] for r in quality_scores(docs, model).collect()}
    assert len(s) == 182 and all(0 <= x <= 1 for x in s.values())
    assert np.mean([(s[k] >= 0.5) == (k < 120) for k in range(0, 180, 4)]) > 0.95
    assert {r["score"] for r in quality_scores(docs, fit_quality(docs, labels.limit(0))).collect()} == {0.5}


def test_quality_scores_are_the_sizes(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (0, 10, 500, 4000, 200_000)] + [None, "x" * 50_000]
    train = spark.createDataFrame([(k, "".join(rng.choice("abcd " if k % 2 else "efgh ") for _ in range(600))) for k in range(200)], "doc_id long, text string")
    model = fit_quality(train, spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, quality int"))
    assert model.bad and model.good
    docs = spark.createDataFrame([(k, x, "s") for k, x in enumerate(texts)] + [(1, texts[1], "s"), (None, "a", "s")], "doc_id long, text string, score string")
    got = quality_scores(docs, model).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        if r["doc_id"] is None:
            continue
        data = (texts[r["doc_id"]] or "").encode()
        size = []
        for d in (model.bad, model.good, b""):
            more = {"dict_data": zstandard.ZstdCompressionDict(d)} if d else {}
            size.append(len(zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, write_dict_id=False, **more).compress(data)))
        z = model.weights[0] + model.weights[1] * (size[0] - size[1]) / size[2] + model.weights[2] * np.log1p(len(data))
        assert abs(r["score"] - 1 / (1 + np.exp(-np.clip(z, -40, 40)))) < 1e-9
    assert quality_scores(docs.limit(0), model).count() == 0
    # The weights are where the weighted likelihood's slope vanishes.
    x = np.array([[0.1, 1.0], [0.2, 3.0], [-0.1, 2.0], [0.4, 0.5], [-0.3, 1.5]])
    y, w = np.array([1, 1, 0, 1, 0.0]), np.ones(5)
    weights = logistic(x, y, w, ridge=0.1)
    a = np.column_stack((np.ones(5), (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9)))
    inner = np.concatenate(([weights[0] + (weights[1:] * x.mean(axis=0)).sum()], weights[1:] * (x.std(axis=0) + 1e-9)))
    slope = a.T @ (y - 1 / (1 + np.exp(-(a @ inner)))) - 0.1 * 5 * inner
    assert np.abs(slope).max() < 1e-6


def test_a_score_on_the_border_counts_as_good():
    model = Compression(b"", b"", (float(np.log(0.3 / 0.7)), 0.0, 0.0))
    assert abs(model.score((0.5, 2.0)) - 0.3) < 1e-12


def test_perspectives_join_to_the_whole(spark):
    turns = [(1, k, "Ann" if k % 3 else "Bob\nX", f"t{k} <|im_end|>\n<|im_start|>assistant" if k % 50 == 0 else f"t{k}", "x") for k in range(600)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, mask string")
    parts, whole = perspectives(df).collect(), {r["perspective"]: r for r in perspectives(df, part_turns=10**6).collect()}
    for who in ("Ann", "Bob\nX"):
        mine = sorted((r for r in parts if r["perspective"] == who), key=lambda r: r["part"])
        assert len(mine) == 3 and "".join(r["text"] for r in mine) == whole[who]["text"]
        assert [m for r in mine for m in r["mask"]] == list(whole[who]["mask"]) and [r["turn_start"] for r in mine] == [0, 256, 512]
        assert [r["text_start"] for r in mine] == [0, len(mine[0]["text"]), len(mine[0]["text"]) + len(mine[1]["text"])]
        assert whole[who]["text"].count("<|im_start|>") == whole[who]["text"].count("<|im_end|>") == 600
        assert "".join(whole[who]["text"][m["s"] : m["e"]] for m in whole[who]["mask"]).count("<|im_end|>") == (400 if who == "Ann" else 200)
    assert perspectives(df.limit(0)).count() == 0


def test_pipeline_keeps_rows_with_null_and_repeated_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = (docs.filter(f"lang = '{x}'").orderBy("doc_id").first() for x in ("en", "de"))
    rows = [(None, a["text"], "en", "s", 1), (5, b["text"], "de", "s", 1), (5, "12 34 ...", "en", "s", 1), (5, b["text"], "de", "s", 1), (7, None, None, "s", None)]
    some = spark.createDataFrame(rows, docs.select(*corpus_pipeline.COLUMNS).schema)
    first = corpus_pipeline.STAGES[0][1](spark, docs.select(*corpus_pipeline.COLUMNS).unionByName(some), SF).filter("source = 's' AND (doc_id IS NULL OR n_chars = 1)").collect()
    assert sorted((r["doc_id"] or -1, r["text"] == a["text"]) for r in first if r["doc_id"] in (None, 5)) == [(-1, True), (5, False), (5, False)]
    for name, stage in corpus_pipeline.STAGES[1:]:
        got = stage(spark, some, SF).collect()
        ids = sorted(r["doc_id"] or -1 for r in got)
        assert ids == ([-1, 5, 5, 7] if name == "near_duplicates" else [-1, 5, 5, 5, 7]), name
        assert stage(spark, some.limit(0), SF).count() == 0


def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "Ann", "hi"), (1, 2, "Bob", None), (1, 300, "Ann", "bye"), (2, 0, "system", "alone"), (None, 0, "x", "y"), (3, None, None, "late"), (3, None, None, "late")]
    out = perspectives(spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, part int")).collect()
    by = {(r["conv_id"], r["perspective"], r["part"]): r for r in out}
    assert set(by) == {(1, "Ann", 0), (1, "Ann", 1), (1, "Bob", 0), (1, "Bob", 1), (3, "unknown", -1)}
    a = by[1, "Ann", 0]
    assert a["text"] == "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=Bob\n<|im_end|>\n"
    assert [a["text"][m["s"] : m["e"]] for m in a["mask"]] == ["hi<|im_end|>\n"]
    assert by[3, "unknown", -1]["n_turns"] == 2


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = spark.createDataFrame(stage(spark, before, SF).collect(), docs.schema)
        assert kept.columns == list(corpus_pipeline.COLUMNS)
        a, b = ({r["doc_id"]: r for r in x.collect()} for x in (before, kept))
        assert set(b) <= set(a)
        if name == "line_dedup":
            from tests.llm.test_dedup import lines_brute

            order = sorted(a)
            want = lines_brute([a[i]["text"] for i in order])
            assert {i: r["text"] for i, r in b.items()} == {i: want[k][0] for k, i in enumerate(order) if want[k][0] or not want[k][2]}
        elif name == "near_duplicates":
            from tests.llm.test_dedup import classes_brute

            order = sorted(a)
            want = classes_brute([a[i]["text"] for i in order])
            assert set(b) == {i for k, i in enumerate(order) if want[k][1] == k}
        elif name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            for i, r in a.items():
                n, hit, _ = hits_brute(r["text"], items, 10)
                assert (i in b) == (len(hit) <= 0.5 * n)
                if i in b:
                    assert norm(b[i]["text"]) == [w for k, w in enumerate(norm(r["text"])) if k not in hit]
        elif name == "language_id":
            assert len(b) >= 0.97 * len(a)
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    sp = SentencePieceProcessor(model_file=PIECES)
    text = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert len(last) == len(text) and all(list(r["ids"]) == sp.encode(text[r["doc_id"]]) for r in last)


@pytest.fixture(scope="module")
def one_id(spark):
    """Labelled and languaged texts: most rows share one doc_id, some have none, many are alike."""
    rng = random.Random(12)
    words = {"x": ["alpha", "beta", "gamma", "delta"], "y": ["uno", "dos", "tres", "cuatro"]}
    rows = [(7 if k % 50 else k if k % 100 else None, " ".join(rng.choices(words["xy"[k % 2]], k=6 + k % 5 * 40)) if k % 3 else "alpha uno " * 30, "xy"[k % 2]) for k in range(20_000)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def test_language_learns_from_a_bounded_number_of_rows(spark, one_id, monkeypatch):
    from dockgrid.llm import language

    seen = []
    monkeypatch.setattr(language, "train_crf", lambda pairs, **_: seen.extend(pairs))
    language.fit_language(one_id, sample=40)
    assert [sum(lang == k for _, lang in seen) for k in "xy"] == [40, 40] and len(set(seen)) == len(seen)


def test_quality_learns_from_a_bounded_number_of_rows(spark, one_id, monkeypatch):
    from dockgrid.llm import quality

    seen = []
    monkeypatch.setattr(quality, "logistic", lambda x, *a, real=quality.logistic: seen.append(len(x)) or real(x, *a))
    monkeypatch.setattr(quality.zstandard, "train_dictionary", lambda n, data, real=zstandard.train_dictionary, **k: seen.append(len(data)) or real(n, data, **k))
    labels = spark.createDataFrame([(7, 0), *((k, 1) for k in range(0, 20_000, 50))], "doc_id long, quality int")
    model = fit_quality(one_id, labels, sample=60)
    assert seen and all(n <= 3 * 60 for n in seen) and 0 <= model.score((0.1, 3.0)) <= 1


def test_an_item_of_many_rows_is_in_many_shards(spark):
    from dockgrid.llm.decontaminate import shards_of

    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(30)) for _ in range(300)]
    items = spark.createDataFrame([(1, t) for t in texts * 2], "item_id long, text string")
    shards = shards_of(items, 10, 1000)
    sizes = [len(r["automaton"]) for r in shards.collect()]
    assert len(sizes) >= 9 and max(sizes) < 3 * sum(sizes) / len(sizes)
    docs = spark.createDataFrame([(k, f"before {t} after") for k, t in enumerate(texts)] + [(1000, "nothing of it")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in contamination(docs, items, 10, 1000).collect()}
    assert all(got[k]["hits"] == [1, 31] and got[k]["items"] == ["1"] for k in range(300)) and got[1000]["hits"] == []
