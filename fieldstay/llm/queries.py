"""One query per operator over its whole table, and the DuckDB statement where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstay.llm import (
    collocations,
    cross_polytope,
    decontamination,
    factor_machine,
    merkle,
    packing,
    preferences,
    quality_rules,
    sharding,
    simhash,
    substrings,
    token_files,
    tokens,
    toxicity,
)
from fieldstay.llm.storage import materialise
from fieldstay.llm.training import remainder
from fieldstay.session import scratch_path, tune

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SEQUENCE = 2048
# Scores from here on count as label 1.
ACCEPTED = 0.3
METADATA = ("n_chars",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    return F.coalesce(remainder(id_col, folds) == fold, F.lit(False))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.withColumnRenamed("id", "doc_id")


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation is chosen over itself with its last answer replaced by the one of the next conversation."""
    turns = table(spark, sf_dir, "conversations")
    answers = turns.filter(F.col("role") == "assistant")
    last = answers.groupBy("conv_id").agg(F.max("turn").alias("last"))
    final = answers.join(last.withColumnRenamed("conv_id", "c"), (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("last")))
    swapped = last.join(final.select((F.col("conv_id") - 1).alias("conv_id"), "role", "text"), "conv_id").select(
        "conv_id", F.col("last").alias("turn"), "role", "text"
    )
    before = turns.join(last, "conv_id", "left").filter(F.col("last").isNull() | (F.col("turn") < F.col("last")))
    rejected = before.select("conv_id", "turn", "role", "text").unionByName(swapped)
    out = preferences.format_preferences(turns, rejected, key="conv_id")
    mask = F.array_join(F.transform("mask", lambda m: F.concat_ws("+", m["start"].cast("string"), m["length"].cast("string"))), ",")
    return out.withColumn("mask", mask)


OP2_SQL = """
WITH answers AS (SELECT conv_id, max(turn) AS last FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
final AS (SELECT c.conv_id, c.role, c.text FROM conversations c JOIN answers a ON c.conv_id = a.conv_id AND c.turn = a.last AND c.role = 'assistant'),
good AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
bad AS (
  SELECT c.conv_id, c.turn, c.role, c.text FROM good c LEFT JOIN answers a ON c.conv_id = a.conv_id WHERE a.last IS NULL OR c.turn < a.last
  UNION ALL
  SELECT a.conv_id, a.last, f.role, coalesce(f.text, '') FROM answers a JOIN final f ON f.conv_id = a.conv_id + 1
), met AS (
  SELECT coalesce(g.conv_id, b.conv_id) AS pair_id, coalesce(g.turn, b.turn) AS turn, g.role AS grole, g.text AS gtext, b.role AS brole, b.text AS btext,
         g.conv_id IS NULL OR b.conv_id IS NULL OR g.role <> b.role OR g.text <> b.text AS differs
  FROM good g FULL JOIN bad b ON g.conv_id = b.conv_id AND g.turn = b.turn
), marked AS (
  SELECT *, min(CASE WHEN differs THEN turn END) OVER (PARTITION BY pair_id) AS first FROM met
), parts AS (
  SELECT pair_id, turn, 'prompt' AS segment, grole AS role, gtext AS text FROM marked WHERE first IS NULL OR turn < first
  UNION ALL SELECT pair_id, turn, 'chosen', grole, gtext FROM marked WHERE turn >= first AND grole IS NOT NULL
  UNION ALL SELECT pair_id, turn, 'rejected', brole, btext FROM marked WHERE turn >= first AND brole IS NOT NULL
), lines AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line, turn // 64 AS part FROM parts
), placed AS (
  SELECT *, sum(length(line)) OVER (PARTITION BY pair_id, segment, part ORDER BY turn) - length(line) AS ahead FROM lines
)
SELECT pair_id, segment, CAST(part AS BIGINT) AS part, count(*) AS n_turns, string_agg(line, '' ORDER BY turn) AS text,
       coalesce(string_agg(CASE WHEN segment <> 'prompt' AND role = 'assistant'
         THEN CAST(CAST(ahead + length(role) + 5 AS BIGINT) AS VARCHAR) || '+' || CAST(length(text) + 8 AS VARCHAR) END, ',' ORDER BY turn), '') AS mask
FROM placed GROUP BY pair_id, segment, part
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), folds=4, held_out=2)
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"),
        in_fold("id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPTED).cast("int").alias("predicted"),
        "threshold",
        "flagged",
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=13)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


OP4_SQL = """
WITH folded AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), d AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM folded
), grams AS (
  SELECT DISTINCT id AS item, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS t
  FROM (SELECT id, w, least(13, len(w)) AS k, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM d WHERE kind = 'b' AND len(w) > 0)
), widths AS (SELECT DISTINCT k FROM grams),
windows AS (
  SELECT id, i, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS t
  FROM (SELECT id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d CROSS JOIN widths WHERE kind = 'd' AND len(w) >= k)
), hits AS (SELECT windows.id, i, windows.k, item FROM windows JOIN grams ON windows.t = grams.t AND windows.k = grams.k),
items AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM hits) GROUP BY id
), covered AS (
  SELECT id, count(*) AS n_hit FROM (SELECT DISTINCT id, unnest(generate_series(i, i + k - 1)) AS p FROM hits) GROUP BY id
)
SELECT d.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN items USING (id) LEFT JOIN covered USING (id) WHERE kind = 'd'
"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), tokens.REMEMBERED_ALONE)


def packed_documents(docs: DataFrame, remembered: int = tokens.REMEMBERED) -> DataFrame:
    pieces = tokens.token_pieces(
        docs, public_tokenizers.path(TOKENIZER), end_id=END_ID, longest=SEQUENCE, remembered=remembered
    )
    digests = materialise(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(digests, capacity=SEQUENCE).select(
        F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=16, carry=(crc,))
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.remove_repeats(table(spark, sf_dir, "documents"), k=20)
    return cleaned.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


# Numbers each window by its earliest place; all but the first cover their words.
OP8_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, list_aggregate(w[i:i + 19], 'string_agg', ' ') AS t
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS i FROM later
), lists AS (
  SELECT doc_id, list(i) AS cut FROM gone GROUP BY doc_id
), words AS (
  SELECT d.doc_id, w, generate_subscripts(w, 1) AS i FROM d
), kept AS (
  SELECT words.doc_id, string_agg(w[words.i], ' ' ORDER BY words.i) AS t
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i WHERE gone.i IS NULL GROUP BY words.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(cut), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "token-files")
    path, most = public_tokenizers.path(TOKENIZER), tokens.REMEMBERED_ALONE
    manifest = token_files.write_token_files(docs, folder, path, end_id=END_ID, remembered=most)
    records = token_files.read_token_files(manifest, folder)
    return records.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_factor_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return factor_machine.score(docs, model, metadata=METADATA, keep=("doc_id",)).select(
        "doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted")
    )


def quality_model(docs: DataFrame, labels: DataFrame) -> factor_machine.Model | None:
    return factor_machine.fit(docs, labels, metadata=METADATA, folds=5, held_out=0)


def op11_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98).withColumnRenamed("id", "vec_id")


# Reachability by repeated minima over the links; copies and near copies make short chains.
OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
  WHERE list_cosine_similarity(p.x, q.x) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN least ON least.a = e.vec_id LEFT JOIN degree ON degree.a = e.vec_id
"""


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    changed = [merkle.field(F.col(c) + 1 if c == "n_chars" else F.col(c)) for c in fields]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, merkle.hexed(merkle.sha(*changed)))
    proved = merkle.manifest(docs, fields=fields, claimed=tampered)
    return proved.withColumnRenamed("id", "doc_id").drop("claimed")


# A level at a time over lists of digests; the CRC-32 is folded bit by bit.
OP12_SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS f,
         [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars + 1 AS VARCHAR), text] AS g,
         list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i: ascii(substr(CAST(doc_id AS VARCHAR), CAST(i + 1 AS INTEGER), 1))) AS bytes
  FROM documents
), leaves AS (
  SELECT doc_id, lang,
    sha256(list_aggregate(list_transform(f, lambda x: CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END), 'string_agg', '')) AS leaf,
    sha256(list_aggregate(list_transform(g, lambda x: CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END), 'string_agg', '')) AS other,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(bytes, lambda b: CAST(b AS BIGINT))), lambda c, b:
      list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) AS crc
  FROM fields
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM leaves
), langs AS (SELECT lang, list(leaf ORDER BY r) AS leaf_list, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM ranked GROUP BY lang),
trees AS (
  SELECT g, 0 AS level, leaf_list AS x FROM langs
  UNION ALL
  SELECT g, level + 1, list_transform(range((len(x) + 1) // 2), lambda i: sha256(x[2 * i + 1] || coalesce(x[2 * i + 2], ''))) FROM trees WHERE len(x) > 1
), subroots AS (SELECT g, x[1] AS subroot, level AS height FROM trees WHERE len(x) = 1),
crown AS (
  SELECT 0 AS level, (SELECT list(subroot ORDER BY g) FROM subroots) AS x
  UNION ALL
  SELECT level + 1, list_transform(range((len(x) + 1) // 2), lambda i: sha256(x[2 * i + 1] || coalesce(x[2 * i + 2], ''))) FROM crown WHERE len(x) > 1
), top AS (SELECT x[1] AS root FROM crown WHERE len(x) = 1),
every AS (
  SELECT g, level AS step, level, x, FALSE AS upper FROM trees WHERE len(x) > 1
  UNION ALL SELECT subroots.g, height + crown.level, crown.level, crown.x, TRUE FROM subroots CROSS JOIN crown WHERE len(crown.x) > 1
), docs AS (
  SELECT ranked.doc_id, langs.g, r, leaf, coalesce(CASE WHEN crc % 7 = 0 THEN other END, leaf) AS claimed
  FROM ranked JOIN langs ON ranked.lang IS NOT DISTINCT FROM langs.lang
), steps AS (
  SELECT doc_id, docs.r AS leaf_r, docs.g, step, x, CASE WHEN upper THEN docs.g ELSE docs.r END // CAST(pow(2, level) AS BIGINT) AS spot
  FROM docs JOIN every USING (g)
), sides AS (
  SELECT g, leaf_r, step, CASE WHEN spot % 2 = 1 THEN x[spot] END AS before, CASE WHEN spot % 2 = 0 THEN x[spot + 2] END AS after FROM steps
), lists AS (
  SELECT g, leaf_r, string_agg(coalesce(before, after, ''), '' ORDER BY step) AS proof, list([coalesce(before, ''), coalesce(after, '')] ORDER BY step) AS sib
  FROM sides GROUP BY g, leaf_r
), folds AS (
  SELECT docs.g, r, 0 AS done, claimed AS h, coalesce(sib, []) AS sib FROM docs LEFT JOIN lists ON lists.g = docs.g AND leaf_r = r
  UNION ALL SELECT g, r, done + 1, sha256(sib[done + 1][1] || h || sib[done + 1][2]), sib FROM folds WHERE done < len(sib)
)
SELECT docs.doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, h AS folded_root, h = root AS verified
FROM docs JOIN subroots ON subroots.g = docs.g CROSS JOIN top LEFT JOIN lists ON lists.g = docs.g AND leaf_r = docs.r
JOIN folds ON folds.g = docs.g AND folds.r = docs.r AND done = len(folds.sib)
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=10, top=2000, covered=50)


OP13_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p FROM documents
), lists AS (SELECT lang, regexp_extract_all(unnest(p), '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS g, count(*) AS f
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM lists CROSS JOIN (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)
  GROUP BY ALL
), totals AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS w FROM grams WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, k, g, a, c, list_aggregate(w[1:c], 'string_agg', ' ') AS lp, list_aggregate(w[c + 1:k], 'string_agg', ' ') AS rp
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS c FROM candidates)
), scored AS (
  SELECT cuts.lang, cuts.k, cuts.g, a, c, x.f AS l, y.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN grams x ON x.lang = cuts.lang AND x.g = lp AND x.k = c JOIN grams y ON y.lang = cuts.lang AND y.g = rp AND y.k = cuts.k - c
), weakest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, c) AS nth FROM scored) WHERE nth = 1
), inside AS (
  SELECT lang, g, max(a) AS most FROM (
    SELECT lang, list_aggregate(w[i:i + 1], 'string_agg', ' ') AS g, a FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE k = 3)
  ) GROUP BY lang, g
), kept AS (
  SELECT weakest.* FROM weakest LEFT JOIN inside ON weakest.k = 2 AND inside.lang = weakest.lang AND inside.g = weakest.g
  WHERE most IS NULL OR 100 * most < 50 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept
)
SELECT ranked.lang, rank, g AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_preferences": op2_preferences,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_packing": op5_packing,
    "op6_sharding": op6_sharding,
    "op7_simhash": op7_simhash,
    "op8_substrings": op8_substrings,
    "op9_token_files": op9_token_files,
    "op10_factor_machine": op10_factor_machine,
    "op11_cross_polytope": op11_cross_polytope,
    "op12_merkle": op12_merkle,
    "op13_collocations": op13_collocations,
}
ORACLES: dict[str, str] = {
    "op2_preferences": OP2_SQL,
    "op4_decontamination": OP4_SQL,
    "op8_substrings": OP8_SQL,
    "op11_cross_polytope": OP11_SQL,
    "op12_merkle": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
