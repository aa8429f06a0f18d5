"""The operators of this subpackage applied to their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (
    auction_repair, bpe_fst, chat_format, decontaminate, exact_dedup, hilbert_negatives, language_fusion, multiset_hash, secret_link, simhash_anchor, source_mix, toxicity_fm, url_automaton,
)
from millrace.llm.texts import whole_text, word_count
from millrace.session import materialize

Query = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

# The rules of the URL query.
SITES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
# What else the URL query blocks: advertising, log-in pages and archives.
GLOBS = [("block", "*.ads.*/**"), ("block", "**/ads/**"), ("block", "**/login/**"), ("block", "**.exe"), ("block", "**.zip")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity_fm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    held_out = toxicity_fm.remainder() == 0
    machine = toxicity_fm.fit(docs, labels.where(~held_out))
    scored = toxicity_fm.score_texts(docs, machine, ["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_multiset_hash(spark: SparkSession, folder: str) -> DataFrame:
    return multiset_hash.compare_edits(table(spark, folder, "documents"))


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = materialize(table(spark, folder, "documents").select(
        "doc_id", "source", word_count(whole_text()).alias("size"), F.monotonically_increasing_id().alias("_row")
    ))
    plan, mixed = source_mix.mix(docs, size=F.col("size"))
    taken = mixed.groupBy("_row").agg(F.sum("size").alias("taken"), F.array_sort(F.collect_list("_shard")).alias("shards"))
    targets = plan.select("number", F.col("source").alias("_source"), "source_size", "target")
    return (
        docs.join(taken, "_row", "left").join(source_mix.hint(targets, targets.count()), F.col("source").eqNullSafe(F.col("_source")))
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "shards")
    )


def op4_simhash_anchor(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_anchor.groups(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.groups(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    fixed = [(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))]
    turns = turns.unionByName(spark.createDataFrame(fixed, turns.schema))
    out = chat_format.format_conversations(turns)
    read = out.withColumn("_turns", chat_format.read_turns(F.col("formatted"))).withColumn(
        "_loss", chat_format.loss_text(F.col("formatted"), F.col("loss"))
    )
    spoken = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_secret_link(spark: SparkSession, folder: str) -> DataFrame:
    return secret_link.scan_texts(table(spark, folder, "documents"), ["doc_id"])


def op8_language_fusion(spark: SparkSession, folder: str) -> DataFrame:
    return language_fusion.identify(table(spark, folder, "pages"), table(spark, folder, "documents"))


def op9_url_automaton(spark: SparkSession, folder: str) -> DataFrame:
    rules = url_automaton.ordered(
        [url_automaton.site_rule(v, r) for v, r in SITES], [url_automaton.Rule(v, None, g) for v, g in GLOBS]
    )
    return url_automaton.judge(table(spark, folder, "pages"), rules)


def op10_bpe_fst(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_fst.round_trip(table(spark, folder, "documents"), RANKS, PATTERN, ["doc_id"])


def op11_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, folder, "benchmark"))
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, run: n + run["end"] - run["first"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


def op12_hilbert_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    mislabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hilbert_negatives.mine(rows.withColumn("label", mislabelled), F.col("vec_id") % 50 == 0)


def op13_auction_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    damaged = auction_repair.damage(turns)
    spoken = F.transform("turns", lambda t: F.concat_ws(":", t["role"], t["text"]))
    return auction_repair.repair(damaged, F.col("times")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.array_join(spoken, "\n"), 256).alias("repaired_sha256"),
    )


def registered() -> dict[str, Query]:
    return {
        "op1_toxicity_fm": op1_toxicity_fm,
        "op2_multiset_hash": op2_multiset_hash,
        "op3_source_mix": op3_source_mix,
        "op4_simhash_anchor": op4_simhash_anchor,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_chat_format": op6_chat_format,
        "op7_secret_link": op7_secret_link,
        "op8_language_fusion": op8_language_fusion,
        "op9_url_automaton": op9_url_automaton,
        "op10_bpe_fst": op10_bpe_fst,
        "op11_decontaminate": op11_decontaminate,
        "op12_hilbert_negatives": op12_hilbert_negatives,
        "op13_auction_repair": op13_auction_repair,
    }


EXACT_DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

CHAT_FORMAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
placed AS (
  SELECT *, row_number() OVER t AS i, lag(role) OVER t AS before, lead(role) OVER t AS after,
         length(regexp_replace(text, '([\[<]\\*)(/?(?:INST|SYS|OUT|ROLE)\]|/?s>)', '\1\\\2', 'g')) AS escaped,
         CASE role WHEN 'system' THEN 5 WHEN 'user' THEN 6 WHEN 'assistant' THEN 5 ELSE 13
              + length(regexp_replace(role, '([\[<]\\*)(/?(?:INST|SYS|OUT|ROLE)\]|/?s>)', '\1\\\2', 'g')) END AS mark
  FROM turns WINDOW t AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(escaped + CASE WHEN before = role THEN 3 ELSE mark END + CASE WHEN after = role THEN 0 ELSE 4 END)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

URL_AUTOMATON_SQL = """
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
ruled AS (
  SELECT *, CASE WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts),
globbed AS (
  SELECT *, CASE WHEN rule IS NOT NULL THEN '*.' || rule || '**'
                 WHEN regexp_full_match('.' || host || path, '(?s)[^/]*[.]ads[.][^/]*/.*') THEN '*.ads.*/**'
                 WHEN contains(path, '/ads/') THEN '**/ads/**'
                 WHEN contains(path, '/login/') THEN '**/login/**'
                 WHEN ends_with(host || path, '.exe') THEN '**.exe'
                 WHEN ends_with(host || path, '.zip') THEN '**.zip' END AS glob_rule
  FROM ruled)
SELECT page_id, host, path, rule, glob_rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') OR rule IS NULL AND glob_rule IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM globbed
"""


DECONTAMINATE_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
item AS (
  SELECT row_number() OVER () AS r, coalesce(item_id::VARCHAR, '') AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
item_words AS (SELECT r, item_id, least(len(words), 10) AS l, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM item),
item_runs AS (
  SELECT item_id, l, list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS run FROM item_words),
windows AS (SELECT DISTINCT item_id, l, array_to_string(run[1:l], ' ') AS run FROM item_runs WHERE len(run) >= l),
doc_words AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM doc),
doc_runs AS (
  SELECT r, i, list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS run FROM doc_words),
found AS (
  SELECT d.r, d.i, w.l, w.item_id
  FROM (SELECT r, i, lengths.l, array_to_string(run[1:lengths.l], ' ') AS run
        FROM doc_runs JOIN (SELECT DISTINCT l FROM windows) AS lengths ON len(doc_runs.run) >= lengths.l) AS d
  JOIN windows AS w ON w.l = d.l AND w.run = d.run),
hits AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + l)) AS i FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""


HILBERT_NEGATIVES_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM usable AS a JOIN usable AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positive AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INT AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive AS p JOIN scored AS n ON n.anchor_id = p.anchor_id AND NOT n.same AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
QUALIFY rank <= 3
"""


def _step(state: str, cost: str, letter: str, said: str = "''") -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'w': {state}.w || '{letter}', 'r': {state}.r || {said}}} END"


def _least(*steps: str) -> str:
    return f"list_min([x FOR x IN [{', '.join(steps)}] IF x IS NOT NULL])"


def _spoken(state: str, initial: str, role: str) -> str:
    """Keeping or reroling the row into ``role`` after ``state``."""
    return (f"CASE WHEN NOT must AND initial = '{initial}' THEN {_step(state, 'more', 'K', 'line')} "
            f"WHEN NOT must THEN {_step(state, '1 + more', 'R', f"chr(10) || '{role}:' || text")} END")


def _inserted(state: str, role: str) -> str:
    return _step(state, "5", "I", f"chr(10) || '{role}:'")


# The four states (z: nothing said, s, u, a: whose turn was last) after each row, each with its cheapest edits.
AUCTION_REPAIR_SQL = rf"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
bytes AS (SELECT DISTINCT name, [ascii(c) FOR c IN string_split(name, '')] AS b FROM source),
crc AS (
  SELECT name, xor(list_reduce(list_prepend(4294967295::BIGINT, [x::BIGINT FOR x IN b]), lambda h, x:
           list_reduce([xor(h, x), 1, 2, 3, 4, 5, 6, 7, 8], lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)),
         4294967295) % 20 AS kind FROM bytes),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM source JOIN crc USING (name)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS initial, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS following, chr(10) || role || ':' || text AS line,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault FROM placed),
rows AS (SELECT *, fault IN ('blank', 'duplicate') AS must, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more FROM judged),
spoken AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'w': '', 'r': ''}} AS z, NULL::STRUCT(c BIGINT, w VARCHAR, r VARCHAR) AS s,
         {{'c': 5::BIGINT, 'w': 'I', 'r': chr(10) || 'user:'}} AS u, {{'c': 10::BIGINT, 'w': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS a
  FROM conversations),
walk AS (
  FROM spoken
  UNION ALL
  SELECT conv_id, i, z, s, u, {_least('a', _inserted('u', 'assistant'))} AS a
  FROM (SELECT conv_id, i, z, s, {_least('u', _inserted('z', 'user'), _inserted('s', 'user'), _inserted('a', 'user'))} AS u, a
    FROM (
      SELECT walk.conv_id, rows.i, {_step('z', '2', 'D')} AS z,
             {_least(_step('s', '2', 'D'), f"CASE WHEN NOT must AND initial = 's' THEN {_step('z', 'more', 'K', 'line')} END")} AS s,
             {_least(_step('u', '2', 'D'), *(_spoken(q, 'u', 'user') for q in 'zsa'))} AS u,
             {_least(_step('a', '2', 'D'), _spoken('u', 'a', 'assistant'))} AS a
      FROM walk JOIN rows ON rows.conv_id IS NOT DISTINCT FROM walk.conv_id AND rows.i = walk.i + 1))),
last AS (SELECT conv_id, {_least('z', 'a')} AS best FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id)
SELECT last.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.w AS audit, sha256(substr(best.r, 2)) AS repaired_sha256
FROM last LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM last.conv_id
"""


def oracle() -> dict[str, str]:
    return {
        "op5_exact_dedup": EXACT_DEDUP_SQL,
        "op6_chat_format": CHAT_FORMAT_SQL,
        "op9_url_automaton": URL_AUTOMATON_SQL,
        "op11_decontaminate": DECONTAMINATE_SQL,
        "op12_hilbert_negatives": HILBERT_NEGATIVES_SQL,
        "op13_auction_repair": AUCTION_REPAIR_SQL,
    }
