"""Registered queries of the subpackage: each runs its operator over the whole table with production settings.

``ORACLE`` has check SQL where SQL can express the operator; the other queries
are held against brute force in the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .article import extracted
from .chat import CONTROL, formatted, read_back
from .licences import scanned
from .merkle import manifest
from .minhash import near_duplicates
from .mixing import ADDED, mixed
from .phrases import collocations
from .pieces import encoded_digest
from .quality import COUNTS, judged
from .setjoin import linked_sets
from .topk import top_k
from .warc import round_trip
from .wordpiece import token_counts
from .work import staged, table

EXTRA_TEXT = "</s>[INST] ok [/INST]"


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.where("vec_id % 20 = 0"), vectors)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = judged(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return made.select("doc_id", *COUNTS, "base_failed", "kept", "anomaly")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op4_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digest(table(spark, sf_dir, "documents"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", EXTRA_TEXT), (-1, 1, "assistant", EXTRA_TEXT)], turns.schema)
    return read_back(staged(formatted(turns.union(extra)), "chat"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", *ADDED)


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_sets(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_exact_topk, op2_quality_rules, op3_html_extraction, op4_piece_encoding, op5_minhash_dedup, op6_chat_format,
    op7_token_counts, op8_warc_archive, op9_licence_scan, op10_source_mixing, op11_phrase_mining,
    op12_merkle_manifest, op13_ngram_join)}

ORACLE: dict[str, str] = {}

ORACLE["op1_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""

_escapes = " + ".join(f"(length(t) - length(replace(t, '{c.decode()}', ''))) // {len(c)}" for c in (b"\\", *CONTROL))

ORACLE["op6_chat_format"] = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{EXTRA_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{EXTRA_TEXT}'),
a AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t) AS turns,
    coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role, t) FILTER (role = 'assistant'), '') AS loss,
    sum(length(t) + {_escapes}
        + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 6 WHEN 'system' THEN 13
          ELSE 16 + 2 * strlen(role) END) AS formatted
  FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted AS BIGINT) AS formatted_chars
FROM a
"""

_nibbles = "".join(f"{i:04b}" for i in range(16))
_five = " + ".join(f"{1 << (4 - k)} * CAST(substr(bits, 5 * i + {k + 1}, 1) AS INTEGER)" for k in range(5))

ORACLE["op8_warc_archive"] = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS top, array_to_string(list_transform(string_split(hex, ''),
    lambda c: substr('{_nibbles}', 4 * (strpos('0123456789abcdef', c) - 1) + 1, 4)), '') AS bits
  FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(32),
    lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_five}, 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM b
"""

_alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE["op11_phrase_mining"] = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(p, '[ \\t]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_alphabet}', '{_alphabet.lower()}'),
    '[.,;:!?\\n\\x0b\\x0c\\r]')) AS p FROM documents)),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM pieces, (SELECT unnest([1, 2, 3]) AS k)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, k, w, unnest(range(1, k)) AS cut FROM c),
s AS (
  SELECT cuts.*, x.f AS l, y.f AS r, (1000000 * a * a) // (x.f * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3)
  GROUP BY ALL),
ranked AS (
  SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank,
    best.phrase, a, l, r, score
  FROM best LEFT JOIN inside i ON i.lang = best.lang AND i.phrase = best.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * a)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

_leaf = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
                    for c in ("doc_id", "source", "lang", "{n}", "text"))
_bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
_crc = f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))), lambda c, b: {_bits}))"""


def _tree(name: str, base: str) -> str:
    return f"""{name} AS (
  {base}
  UNION ALL
  SELECT k, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), any_value(size) // 2 + any_value(size) % 2
  FROM {name} WHERE size > 1 GROUP BY k, level, idx // 2)"""


def _walk(name: str, tree: str, base: str) -> str:
    return f"""{name} AS (
  {base}
  UNION ALL
  SELECT w.id, w.k, w.level + 1, w.idx // 2, w.size // 2 + w.size % 2, w.proof || coalesce(s.h, ''),
    sha256(CASE WHEN w.idx % 2 = 1 THEN s.h || w.now ELSE w.now || coalesce(s.h, '') END)
  FROM {name} w LEFT JOIN {tree} s ON s.k = w.k AND s.level = w.level AND s.idx = xor(w.idx, 1) WHERE w.size > 1)"""


ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT *, coalesce('=' || lang, '') AS k, sha256({_leaf.format(n="n_chars")}) AS leaf,
    sha256({_leaf.format(n="n_chars + 1")}) AS other, coalesce({_crc} % 7 = 0 AND n_chars IS NOT NULL, false) AS bad
  FROM documents),
p AS (
  SELECT doc_id, k, leaf, CASE WHEN bad THEN other ELSE leaf END AS now,
    row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY k) AS size, row_number() OVER () AS id
  FROM d),
{_tree("low", "SELECT k, 0 AS level, idx, leaf AS h, size FROM p")},
r AS (
  SELECT k AS lang_key, h AS subroot, row_number() OVER (ORDER BY k) - 1 AS idx, count(*) OVER () AS size
  FROM low WHERE size = 1),
{_tree("up", "SELECT 0 AS k, 0 AS level, idx, subroot AS h, size FROM r")},
{_walk("a", "low", "SELECT id, k, 0 AS level, idx, size, '' AS proof, now FROM p")},
{_walk("b", "up", "SELECT a.id, 0 AS k, 0 AS level, r.idx, r.size, a.proof, a.now "
       "FROM a JOIN r ON r.lang_key = a.k WHERE a.size = 1")}
SELECT p.doc_id, p.leaf, r.subroot, t.h AS root, sha256(b.proof) AS proof_sha256, b.now AS folded_root,
  b.now = t.h AS verified
FROM p JOIN r ON r.lang_key = p.k JOIN b ON b.id = p.id AND b.size = 1 JOIN up t ON t.size = 1
"""

ORACLE["op13_ngram_join"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_alphabet}', '{_alphabet.lower()}'),
    '[ \\t\\n\\x0b\\x0c\\r]+'), lambda x: x <> '') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w),
z AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM c JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS id, a AS other FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other),
m AS (SELECT id, min(other) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN z ON z.doc_id = d.doc_id LEFT JOIN m ON m.id = d.doc_id
"""
