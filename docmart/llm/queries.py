"""One query per operator, over whole tables, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.llm import bpe, chat_tools, exact_dedup, fm_index, importance, langid, lm_score, mixing, rlz, simhash, suffix, toxicity, trie
from docmart.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


TOOLS = {
    "search": {"type": "object", "properties": {"text": {"type": "string"}, "turn": {"type": "integer", "minimum": 0}}, "required": ["text", "turn"], "additionalProperties": False},
    "translate": {"type": "object", "properties": {"text": {"type": "string"}, "turn": {"type": "integer"}}, "required": ["text"]},
    "summarise": {"type": "object", "properties": {"turn": {"type": "string"}}, "required": ["turn", "length"]},
}


@_query
def op1_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every answer of an assistant becomes a call whose arguments hold its whole text; the user's
    next message is the result. A call depends on the one before it."""
    turns = table(spark, sf_dir, "conversations")
    calls = turns.where("role = 'assistant'").select(
        "conv_id",
        F.col("turn").alias("seq"),
        F.concat(F.lit("c"), F.col("turn").cast("string")).alias("call_id"),
        F.element_at(F.array(*map(F.lit, TOOLS)), (F.pmod("turn", F.lit(3)) + 1).cast("int")).alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"),
        F.when(F.col("turn") > 1, F.array(F.concat(F.lit("c"), (F.col("turn") - 2).cast("string")))).alias("depends_on"),
    )
    results = turns.where("role = 'user'").select("conv_id", F.concat(F.lit("c"), (F.col("turn") - 1).cast("string")).alias("call_id"), F.col("text").alias("content"))
    return chat_tools.link(calls, results.where("call_id <> 'c-1'"), TOOLS).withColumn("errors", F.array_join("errors", "; ")).withColumn("missing", F.array_join("missing", ","))


ORACLES["op1_chat_tools"] = """
WITH RECURSIVE calls AS (
    SELECT conv_id, turn AS seq, 'c' || turn AS call_id, ['search', 'translate', 'summarise'][turn % 3 + 1] AS name, text,
           CASE WHEN turn > 1 THEN turn - 2 END AS dep
    FROM conversations WHERE role = 'assistant'),
results AS (SELECT conv_id, 'c' || (turn - 1) AS call_id, text AS content FROM conversations WHERE role = 'user' AND turn > 0),
known AS (SELECT c.*, EXISTS (SELECT 1 FROM calls d WHERE d.conv_id = c.conv_id AND d.seq = c.dep) AS has FROM calls c),
lv AS (SELECT conv_id, seq, 0 AS level FROM known WHERE NOT has
       UNION ALL SELECT k.conv_id, k.seq, lv.level + 1 FROM known k JOIN lv ON k.conv_id = lv.conv_id AND k.dep = lv.seq),
joined AS (SELECT coalesce(k.conv_id, r.conv_id) AS conv_id, coalesce(k.call_id, r.call_id) AS call_id, k.seq, lv.level, k.name, k.text, k.dep, k.has, r.content, k.seq IS NOT NULL AS call, r.call_id IS NOT NULL AS got
           FROM known k FULL JOIN results r ON k.conv_id = r.conv_id AND k.call_id = r.call_id LEFT JOIN lv ON lv.conv_id = k.conv_id AND lv.seq = k.seq)
SELECT conv_id, call_id, seq, level::INTEGER AS level, name,
       CASE WHEN NOT call THEN 'orphan' WHEN got THEN 'linked' ELSE 'pending' END AS status,
       CASE WHEN call THEN name <> 'summarise' END AS valid,
       CASE WHEN name = 'summarise' THEN '$.length: missing; $.turn: not of type string' ELSE '' END AS errors,
       CASE WHEN call AND dep IS NOT NULL AND NOT has THEN 'c' || dep ELSE '' END AS missing,
       CASE WHEN call THEN 1 ELSE 0 END::BIGINT AS n_calls, CASE WHEN got THEN 1 ELSE 0 END::BIGINT AS n_results,
       CASE WHEN call THEN '{"arguments":{"text":' || to_json(text) || ',"turn":' || seq || '},"depends_on":[' || CASE WHEN dep IS NULL THEN '' ELSE '"c' || dep || '"' END
            || '],"id":"' || call_id || '","level":' || level || ',"name":"' || name || '","result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}'
            ELSE '{"id":"' || call_id || '","result":' || to_json(content) || '}' END AS json
FROM joined
"""


@_query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"), words_each=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


ORACLES["op3_exact_dedup"] = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, sha256(coalesce(text, '')) AS text_sha256
      FROM documents WINDOW same AS (PARTITION BY coalesce(text, '')))
"""


@_query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    scored = lm_score.score(table(spark, sf_dir, "documents"), good)
    return scored.select("doc_id", (F.round("score", 6) + 0.0).alias("score"), "n_words")


ORACLES["op4_lm_scoring"] = """
WITH words AS (SELECT doc_id, w, len(w) AS n, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents)),
tokens AS (SELECT doc_id, good, CASE WHEN i = 1 THEN ' start' ELSE w[i - 1] END AS a, w[i] AS b FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM words)),
seconds AS (SELECT b, count(*) AS c0, count(*) FILTER (good) AS c1 FROM tokens GROUP BY b),
firsts AS (SELECT a, count(*) AS c0, count(*) FILTER (good) AS c1 FROM tokens GROUP BY a),
pairs AS (SELECT a, b, count(*) AS c0, count(*) FILTER (good) AS c1 FROM tokens GROUP BY a, b),
sizes AS (SELECT count(*) + 2 AS v, sum(c0) AS n0, sum(c1) AS n1 FROM seconds),
low AS (SELECT b, (c0 + 1) / (n0 + v) AS p0, (c1 + 1) / (n1 + v) AS p1 FROM seconds, sizes),
loss AS (SELECT a, b, ln(0.7::DOUBLE * p.c0 / f.c0 + 0.3::DOUBLE * p0) - ln(CASE WHEN f.c1 > 0 THEN 0.7::DOUBLE * p.c1 / f.c1 + 0.3::DOUBLE * p1 ELSE p1 END) AS x
         FROM pairs p JOIN firsts f USING (a) JOIN low USING (b)),
means AS (SELECT doc_id, sum(x) / count(*) AS score FROM tokens JOIN loss USING (a, b) GROUP BY doc_id)
SELECT w.doc_id, round(coalesce(m.score, 0), 6) + 0.0::DOUBLE AS score, w.n AS n_words FROM words w LEFT JOIN means m ON w.doc_id = m.doc_id
"""


def _cut(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


@_query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rlz.duplicate_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", _cut("spans").alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op5_substring_dedup"] = """
WITH words AS (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents)),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, n - 48)) AS i FROM words WHERE n >= 50)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS first FROM windows) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM later),
kept AS (SELECT p.doc_id, string_agg(p.w[p.j], ' ' ORDER BY p.j) AS text, count(*) AS n FROM (SELECT doc_id, w, unnest(range(1, n + 1)) AS j FROM words) p ANTI JOIN gone USING (doc_id, j) GROUP BY p.doc_id)
SELECT w.doc_id, w.n AS n_words, w.n - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""


@_query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.duplicate_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", _cut("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op7_suffix_dedup"] = """
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (SELECT doc_id, i, h[2 * i + 1:2 * i + 200] AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM raw WHERE len(h) >= 200)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM strings) WHERE k > 1),
runs AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM later),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b, row_number() OVER (PARTITION BY doc_id ORDER BY min(i)) AS k
          FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM runs) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY k), 0) AS x, a AS y FROM spans
         UNION ALL SELECT r.doc_id, coalesce(max(s.b), 0), len(any_value(r.h)) // 2 FROM raw r LEFT JOIN spans s ON r.doc_id = s.doc_id GROUP BY r.doc_id),
kept AS (SELECT g.doc_id, string_agg(r.h[2 * x + 1:2 * y], '' ORDER BY x) AS h FROM gaps g JOIN raw r ON g.doc_id = r.doc_id GROUP BY g.doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM spans GROUP BY doc_id)
SELECT r.doc_id, len(r.h) // 2 AS n_bytes, (len(r.h) - len(k.h)) // 2 AS n_removed, coalesce(c.n, 0) AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM raw r JOIN kept k ON r.doc_id = k.doc_id LEFT JOIN counts c ON r.doc_id = c.doc_id
"""


@_query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@_query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(mixing.token_counts(table(spark, sf_dir, "documents")))


@_query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


_WINDOWS = """
    SELECT id, n, i, array_to_string(w[i:least(i + 9, n)], ' ') AS win
    FROM (SELECT id, w, n, unnest(range(1, greatest(n - 9, 1) + 1)) AS i FROM (
        SELECT id, w, len(w) AS n FROM (
            SELECT {id} AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table})) WHERE n > 0)
"""
ORACLES["op9_decontamination"] = f"""
WITH items AS (SELECT *, len(string_split(win, ' ')) AS k FROM ({_WINDOWS.format(id="item_id", table="benchmark")})),
lengths AS (SELECT DISTINCT k FROM items),
words AS (SELECT id, w, len(w) AS n FROM (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents)),
places AS (SELECT id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM (SELECT id, w, k, unnest(range(1, n - k + 2)) AS i FROM words, lengths WHERE n >= k)),
hits AS (SELECT p.id, p.i, p.k, t.id AS item FROM places p JOIN items t USING (win, k)),
covered AS (SELECT id, count(DISTINCT j) AS n_hit FROM (SELECT id, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT id, i, k FROM hits)) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM hits WHERE item IS NOT NULL) GROUP BY id)
SELECT w.id AS doc_id, w.n AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN covered c ON w.id = c.id LEFT JOIN named m ON w.id = m.id
"""


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


@_query
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return decoded.select("doc_id", "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


@_query
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@_query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = trie.forked(trie.turns(table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(turns, convs)
