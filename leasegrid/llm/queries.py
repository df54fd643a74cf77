"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leasegrid.llm import bpe, conversation_repair, conversation_trie, embedding_dedup, language_id, line_dedup, ngram_join, order_minhash, packing, permutation_ann, quality, sharding, tool_calls
from leasegrid.llm.shared import data_file, scratch_dir

#: Capacity of a packed bin in bytes, about 4,096 tokens.
CAPACITY = 16_384
QUALITY_LEAST = 0.3
SCHEMAS = {"reply": {"prompt": ("string", True), "turn": ("integer", True)}}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(parts: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts, F.lit(-1))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.9)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(_fold(3) != 1))
    out = language_id.identify(docs, model)
    return out.select("doc_id", (_fold(3) == 1).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    store = sharding.ShardStore(spark, f"{scratch_dir(spark)}/shards-{uuid.uuid4().hex}", target_bytes=32 << 20)
    store.append(docs, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(8)))
    store.compact()
    store.vacuum()
    out = store.read()
    if out is None:
        out = docs.limit(0).select(F.struct("*").alias("row"), *[F.lit(0).alias(c) for c in ("run", "tier", "shard")])
    return out.select("row.doc_id", "run", "tier", "shard", F.octet_length("row.text").alias("n_bytes"), F.sha2(F.col("row.text"), 256).alias("text_sha256"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), min_docs=3, min_chars=20)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out = quality.score(docs, quality.fit(docs, labels.where(_fold(5) > 0)))
    return out.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = bpe.round_trip(_table(spark, sf_dir, "documents"), data_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.from_turns(_table(spark, sf_dir, "conversations"))
    out = tool_calls.link(calls, results, SCHEMAS)
    return out.select("conv_id", "call_id", "depth", "status", "n_results", F.array_join("errors", "; ").alias("errors"), "json")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), n=5, percent=80)


def op9_permutation_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), CAPACITY)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(_table(spark, sf_dir, "conversations"))


def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_edited(_table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie_of_rebuilt(_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_language_id, op3_sharding, op4_line_dedup, op5_quality, op6_byte_bpe, op7_tool_calls, op8_ngram_join, op9_permutation_ann, op10_packing, op11_conversation_repair, op12_order_minhash, op13_conversation_trie)}

_KEY = r"translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: CRC-32 of a text of ASCII letters by its table, as CTEs for WITH RECURSIVE.
_CRC = """crc(i, c, k) AS (SELECT i, i::BIGINT, 0 FROM range(256) t(i) UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END, k + 1 FROM crc WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8)"""


def _crc(text: str) -> str:
    return f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295::BIGINT)"


def _plus(state: str, cost: str, letters: str) -> str:
    """A state's best so far, ten digits of cost and then the letters, so that texts compare as it has to; ~ if it can't be."""
    return f"CASE WHEN {state} = '~' THEN '~' ELSE printf('%010d', left({state}, 10)::BIGINT + {cost}) || substr({state}, 11) || '{letters}' END"


def _stays(state: str, role: str, before: str = "", more: int = 0) -> str:
    """A turn that stays: kept if its role is the one due, or given that role."""
    return f"CASE WHEN x = '{role}' THEN {_plus(state, f'{more} + t', before + 'K')} ELSE '~' END, {_plus(state, f'{more + 2} + t', before + 'R')}"


_STEP = {
    "e": _plus("e", "3", "D"),
    "s": f"CASE WHEN go THEN {_plus('s', '3', 'D')} ELSE least({_plus('s', '3', 'D')}, CASE WHEN x = 's' THEN {_plus('e', 't', 'K')} ELSE '~' END) END",
    "u": f"CASE WHEN go THEN {_plus('u', '3', 'D')} ELSE least({_plus('u', '3', 'D')}, {', '.join(_stays(z, 'u') for z in 'esa')}, {_stays('u', 'u', 'I', 2)}) END",
    "a": f"CASE WHEN go THEN {_plus('a', '3', 'D')} ELSE least({_plus('a', '3', 'D')}, {_stays('u', 'a')}, {', '.join(_stays(z, 'a', 'I', 2) for z in 'esa')}) END",
}

SQL = {
    "op1_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.m, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(c.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) c ON c.a = e.vec_id""",
    "op4_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, line, i, {_KEY} AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
often AS (SELECT key, max(doc_id) AS top FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT l.*, o.key IS NOT NULL AND l.doc_id <> o.top AS gone FROM lines l LEFT JOIN often o ON o.key = l.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op7_tool_calls": """
WITH users AS (SELECT conv_id, turn, text, turn - 2 * row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM conversations WHERE role = 'user'),
calls AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id, island ORDER BY turn) - 1 AS depth FROM users),
results AS (SELECT conv_id, turn - 1 AS turn, text FROM conversations WHERE role = 'assistant')
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.conv_id, r.conv_id) || '-' || coalesce(c.turn, r.turn) AS call_id, c.depth::BIGINT AS depth,
  CASE WHEN c.conv_id IS NULL THEN 'orphan' WHEN r.conv_id IS NULL THEN 'open' ELSE 'linked' END AS status,
  (r.conv_id IS NOT NULL)::BIGINT AS n_results, CASE WHEN c.conv_id IS NULL THEN 'call missing' ELSE '' END AS errors,
  CASE WHEN c.conv_id IS NULL THEN json_object('id', r.conv_id || '-' || r.turn, 'result', r.text)::VARCHAR
  ELSE json_object('arguments', json_object('prompt', c.text, 'turn', c.turn), 'id', c.conv_id || '-' || c.turn,
    'parent', CASE WHEN c.depth > 0 THEN c.conv_id || '-' || (c.turn - 2) END, 'result', r.text, 'tool', 'reply')::VARCHAR END AS json
FROM calls c FULL JOIN results r ON r.conv_id = c.conv_id AND r.turn = c.turn""",
    "op8_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, hash(gram) AS gram FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS gram FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
half AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c.m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) c ON c.a = d.doc_id""",
    "op11_conversation_repair": rf"""
WITH RECURSIVE {_CRC},
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations, tab),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM raw, range(2) c(i) WHERE k <> 0 AND (i = 0 OR k = 3)),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
  regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last, left(role, 1) AS x FROM damaged),
f AS (SELECT *, CASE WHEN last = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
  coalesce(lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x NOT IN ('su', 'ua', 'au'), false) AS odd FROM r),
g AS (SELECT *, fault IN ('b', 'd') AS go, (fault = 't')::INT AS t FROM f),
convs AS (SELECT DISTINCT conv_id FROM conversations),
told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (odd) AS illegal FROM f GROUP BY 1),
dp(conv_id, i, e, s, u, a) AS (SELECT conv_id, 0::BIGINT, '0000000000', '~', '~', '~' FROM convs UNION ALL
  SELECT d.conv_id, g.i, {", ".join(f"{_STEP[z]}" for z in "esua")} FROM dp d JOIN g ON g.conv_id IS NOT DISTINCT FROM d.conv_id AND g.i = d.i + 1),
best AS (SELECT conv_id, least(e, a, {_plus("u", "2", "I")}, {_plus("s", "4", "II")}) AS b FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
letters AS (SELECT conv_id, j, substr(b, 10 + j, 1) AS c FROM (SELECT conv_id, b, unnest(range(1, length(b) - 9)) AS j FROM best)),
placed AS (SELECT *, count(*) FILTER (c <> 'I') OVER w AS i, count(*) FILTER (c <> 'D') OVER w AS m, count(*) FILTER (c <> 'D') OVER (PARTITION BY conv_id) AS n FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY j ROWS UNBOUNDED PRECEDING)),
said AS (SELECT p.conv_id, sha256(string_agg(CASE WHEN c = 'K' THEN role WHEN (n - m) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN c = 'I' THEN '' ELSE text END, chr(10) ORDER BY j)) AS h
  FROM placed p LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.i = p.i WHERE c <> 'D' GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  left(b, 10)::BIGINT AS cost, substr(b, 11) AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM convs c JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op13_conversation_trie": f"""
WITH RECURSIVE {_CRC},
o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, m, conv_id - conv_id % 5 AS base, {_crc("conv_id::VARCHAR")} % 9 AS h FROM (SELECT conv_id, max(p) AS m FROM o GROUP BY 1), tab),
r AS (SELECT o.conv_id, p - c.h + least(c.h, coalesce(b.m, 0)) AS d, role, text FROM o JOIN c USING (conv_id) LEFT JOIN c b ON b.conv_id = c.base WHERE p > c.h
  UNION ALL SELECT c.conv_id, p, role, text FROM c JOIN o ON o.conv_id = c.base WHERE p <= h),
n AS (SELECT conv_id, d, octet_length(encode(text)) AS bytes, md5(array_to_string(list(md5(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY d), '')) AS path FROM r UNION ALL SELECT conv_id, 0, 0, '' FROM c),
m AS (SELECT *, min(conv_id) OVER (PARTITION BY d, path) AS node, count(*) OVER (PARTITION BY d, path) AS n, max(d) OVER (PARTITION BY conv_id) AS last FROM n),
nodes AS (SELECT x.node, x.d, x.n, min(y.node) AS parent, max((x.n - 1) * x.bytes) AS saved, sha256(coalesce(string_agg(x.conv_id::VARCHAR, ',' ORDER BY x.conv_id) FILTER (x.last = x.d), '')) AS ends
  FROM m x LEFT JOIN m y ON y.conv_id = x.conv_id AND y.d = x.d - 1 GROUP BY 1, 2, 3),
kids AS (SELECT parent, d - 1 AS d, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN kids ON kids.parent = node AND kids.d = nodes.d),
below AS (SELECT DISTINCT a.node AS top, a.d AS top_d, b.node, b.d FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.d >= a.d)
SELECT t.node AS conv_id, t.d AS depth, t.parent AS parent_conv_id, t.n AS n_convs, t.k AS n_children, count(*) FILTER (s.k = 0) AS n_leaves, sum(s.saved)::BIGINT AS saved_tokens, t.ends AS ends_sha256
FROM full_nodes t JOIN below ON top = t.node AND top_d = t.d JOIN full_nodes s ON s.node = below.node AND s.d = below.d GROUP BY ALL""",
}
