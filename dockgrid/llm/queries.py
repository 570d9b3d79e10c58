"""The registered queries of the text operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockgrid.llm.chat import perspectives
from dockgrid.llm.common import doc_hash, table
from dockgrid.llm.decontaminate import contamination
from dockgrid.llm.exact_dedup import exact_dedup
from dockgrid.llm.fill_middle import fill_in_middle, restored
from dockgrid.llm.language import fit_language, languages
from dockgrid.llm.line_dedup import line_dedup
from dockgrid.llm.near_dup import near_duplicates
from dockgrid.llm.quality import fit_quality, held_out, quality_scores
from dockgrid.llm.repetition import COVERAGE, LINES, SYMBOLS, quality_rules
from dockgrid.llm.resample import importance_resample
from dockgrid.llm.sentencepiece_codec import sentencepiece
from dockgrid.llm.substring_dedup import substring_dedup
from dockgrid.llm.token_counts import token_counts


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text; null and empty texts have none. Repeated rows are counted each."""
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), limit=2048)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal whole texts, null as empty; the row of the largest doc_id stays, of rows alike one."""
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text, null as empty; fitted on labelled rows that are not held out, a bounded sample. Repeated ids are scored each."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels.filter(F.pmod(doc_hash(), F.lit(5)) != 0))
    scored = quality_scores(docs, model)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates over all whole texts; null and empty ones link with nothing, rows with null doc_id are left out."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words under windows of 50 that a smaller doc_id holds too; null texts hold no words, null doc_ids lose nothing."""
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue once for each speaker; null texts are empty turns. Digests of the renderings and their masks."""
    out = perspectives(table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("mask", lambda x: F.concat_ws("-", x["s"].cast("string"), x["e"].cast("string"))), ",")
    learned = F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return out.select("conv_id", "perspective", "part", "text_start", "n_turns", F.char_length("text").cast("long").alias("n_chars"), learned.alias("n_learned"), mask.alias("mask"), F.sha2("text", 256).alias("text_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that a smaller doc_id holds too go; null and empty texts are one empty line, null doc_ids keep theirs."""
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, `und` without letters; fitted on rows that are not held out, a bounded sample. Ties go by the alphabet."""
    docs = table(spark, sf_dir, "documents")
    found = languages(docs.select("doc_id", "text"), fit_language(docs.filter(F.pmod(doc_hash(), F.lit(3)) != 1)))
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and their decoding; null and empty texts have none. Repeated rows are encoded each."""
    return sentencepiece(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), with_ids=False).drop("ids")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words inside benchmark windows, of every whole text; null texts have no words. Items of one id are one item."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.expr("cast(aggregate(transform(hits, (x, i) -> IF(i % 2 = 1, x, -x)), 0, (a, x) -> a + x) AS bigint)")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents drawn towards the benchmark's distribution of word pairs; null texts hold no words and are never drawn."""
    drawn = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at line ends into prefix, middle and suffix; null and empty texts are plain, with no units."""
    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and verdicts of every document; null and empty texts hold no words and fail the base rule."""
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def queries() -> dict:
    return {f.__name__: f for f in (op1_token_counts, op2_exact_dedup, op3_quality, op4_near_duplicates, op5_substring_dedup, op6_perspectives, op7_line_dedup, op8_language, op9_sentencepiece, op10_decontaminate, op11_importance_resample, op12_fill_middle, op13_quality_rules)}


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: Words between ASCII white space, numbered from 1, of a text expression.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP2 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

OP4 = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
classes AS (SELECT min(doc_id) AS rep, any_value(s) AS s, len(any_value(s)) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets WHERE len(s) > 0) GROUP BY s),
shingles AS (SELECT rep, n, unnest(s) AS g FROM classes),
pairs AS (SELECT a.rep AS a, b.rep AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(node, other) AS (SELECT rep, rep FROM classes UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.other = e.a),
labels AS (SELECT node, min(other) AS label FROM reach GROUP BY node),
members AS (SELECT m.doc_id, len(m.s) AS n, l.label FROM (SELECT doc_id, list_sort(s) AS s FROM sets) m LEFT JOIN (SELECT rep, s FROM classes) c ON m.s = c.s LEFT JOIN labels l ON c.rep = l.node)
SELECT doc_id, n AS n_shingles, coalesce(label, doc_id) AS component_id FROM members
"""

OP5 = f"""
WITH words AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, i AS p, sha256(array_to_string(w[i:i+49], ' ')) AS h FROM words, unnest(range(1, len(w) - 48)) AS t(i)),
firsts AS (SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h),
starts AS (SELECT doc_id, list(p) AS ps FROM windows JOIN firsts USING (h) WHERE doc_id > first_doc GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, p + k AS i FROM starts, unnest(ps) AS t(p), unnest(range(0, 50)) AS u(k)),
numbered AS (SELECT doc_id, i, w[i] AS word FROM words, unnest(range(1, len(w) + 1)) AS t(i)),
kept AS (SELECT n.doc_id, string_agg(n.word, ' ' ORDER BY n.i) AS text FROM numbered n ANTI JOIN gone g ON n.doc_id = g.doc_id AND n.i = g.i GROUP BY n.doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(c.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN counts c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

OP6 = """
WITH t AS (SELECT conv_id, turn // 256 AS part, turn, role, replace(replace(role, '<|im_', '< |im_'), chr(10), ' ') AS name, replace(coalesce(text, ''), '<|im_', '< |im_') AS text FROM conversations),
who AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
p AS (SELECT t.conv_id, w.perspective, t.part, t.turn, t.role = w.perspective AS mine, '<|im_start|>' || CASE WHEN t.role = 'system' THEN 'system' WHEN t.role = w.perspective THEN 'assistant' ELSE 'user name=' || t.name END || chr(10) AS head, t.text || '<|im_end|>' || chr(10) AS body FROM t JOIN who w USING (conv_id)),
o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective ORDER BY turn ROWS UNBOUNDED PRECEDING) AS e FROM p)
SELECT conv_id, perspective, part, min(e - length(head) - length(body))::BIGINT AS text_start, count(*) AS n_turns, sum(length(head) + length(body))::BIGINT AS n_chars, coalesce(sum(length(body)) FILTER (mine), 0)::BIGINT AS n_learned,
    coalesce(string_agg((e - length(body)) || '-' || e, ',' ORDER BY turn) FILTER (mine), '') AS mask, sha256(string_agg(head || body, '' ORDER BY turn)) AS text_sha256
FROM o GROUP BY conv_id, perspective, part
"""

OP7 = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, i, ls[i] AS line, {_LOWER.format(f"trim(ls[i], {_WHITE})")} AS k FROM split, unnest(range(1, len(ls) + 1)) AS t(i)),
firsts AS (SELECT k, min(doc_id) AS first_doc FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (l.doc_id > f.first_doc) AS n_dropped,
    sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (f.first_doc IS NULL OR l.doc_id = f.first_doc), '')) AS kept_sha256
FROM lines l LEFT JOIN firsts f USING (k) GROUP BY l.doc_id
"""

_NORMAL = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP10 = f"""
WITH d AS (SELECT doc_id, {_NORMAL.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
b AS (SELECT item_id, {_NORMAL.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, lengths, unnest(range(1, greatest(len(w) - n + 2, 1))) AS t(i)),
hits AS (SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.g = x.g),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM hits, unnest(range(0, n)) AS t(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(w.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items, sha256(coalesce(i.s, '')) AS items_sha256, coalesce(w.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words w USING (doc_id) LEFT JOIN items i USING (doc_id)
"""


#: CRC-32 by its table; runs of one and two words, numbered in no order.
OP11 = f"""
WITH crc AS MATERIALIZED (SELECT list(list_reduce(list_concat([n], range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY n) AS t FROM range(256) r(n)),
docs AS MATERIALIZED (SELECT doc_id, {_NORMAL.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
marks AS (SELECT {_NORMAL.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
runs AS MATERIALIZED (SELECT doc_id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f FROM docs),
sought AS MATERIALIZED (SELECT unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f FROM marks),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM runs UNION SELECT f FROM sought)),
hashed AS MATERIALIZED (SELECT f, xor(list_reduce(list_concat([4294967295], [('0x' || h[2 * i + 1:2 * i + 2])::BIGINT FOR i IN range(len(h) // 2)]), lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256)), 4294967295) % 10000 AS b FROM hexed, crc),
s AS (SELECT b, count(*) AS n FROM runs JOIN hashed USING (f) GROUP BY b), t AS (SELECT b, count(*) AS n FROM sought JOIN hashed USING (f) GROUP BY b),
gains AS MATERIALIZED (SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s)::DOUBLE + 10000) / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t)::DOUBLE + 10000))))::BIGINT AS g FROM range(10000) r(b) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
weights AS (SELECT doc_id, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS w FROM runs JOIN hashed USING (f) JOIN gains USING (b) GROUP BY doc_id),
scored AS (SELECT d.doc_id, len(d.w) AS n_words, coalesce(n, 0) AS n_features, coalesce(x.w, 0) AS weight, coalesce(x.w, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || d.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM docs d LEFT JOIN weights x USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT s.doc_id, s.n_features::BIGINT AS n_features, s.weight, s.score, r.r::BIGINT AS rank FROM scored s LEFT JOIN (SELECT doc_id, r FROM ranked WHERE r <= 25 * n // 100) r USING (doc_id)
"""

OP12 = r"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || doc_id) AS h FROM documents),
h AS (SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM u),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

_COVERED = ", ".join(f"sum(c) FILTER (list_contains(r, {n})) AS c{n}" for n in COVERAGE)
_VERDICT = " AND ".join(f"100 * coalesce(c{n}, 0) <= {most} * word_chars" for n, most in COVERAGE.items())
_LENGTHS = ", ".join(map(str, sorted({5, *COVERAGE})))
OP13 = f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, unnest([{_LENGTHS}]) AS x(n), unnest(range(1, greatest(len(w) - n + 2, 1))) AS t(i)),
twice AS (SELECT doc_id, n, unnest(list(i)) AS i FROM windows GROUP BY doc_id, n, g HAVING count(*) > 1),
within AS (SELECT doc_id, i + k AS i, list(DISTINCT n) AS r FROM twice, unnest(range(0, n)) AS u(k) GROUP BY doc_id, i + k),
covered AS (SELECT doc_id, sum(1) FILTER (list_contains(r, 5)) AS n_repeat, {_COVERED} FROM (SELECT x.doc_id, r, length(w[i]) AS c FROM within x JOIN d USING (doc_id)) GROUP BY doc_id),
lines AS (SELECT doc_id, l, count(*) AS n, regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g') AS k FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) GROUP BY doc_id, l HAVING count(*) > 1),
again AS (SELECT doc_id, sum(n - 1) AS n_dup, sum((n - 1) * length(k)) AS c_dup FROM lines WHERE k <> '' GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, c_dup, {", ".join(f"c{n}" for n in COVERAGE)} FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN again USING (doc_id)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 100 * coalesce(c_dup, 0) <= {LINES} * word_chars AND 100 * n_symbols <= {SYMBOLS} * n_words AND {_VERDICT} AS kept FROM j
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2, "op4_near_duplicates": OP4, "op5_substring_dedup": OP5, "op6_perspectives": OP6, "op7_line_dedup": OP7, "op10_decontaminate": OP10, "op11_importance_resample": OP11, "op12_fill_middle": OP12, "op13_quality_rules": OP13}
