"""The registered queries of the operators: thin, whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm import (
    bpe,
    chat_format,
    collocations,
    jaccard_join,
    merkle,
    mixing,
    quality,
    substring_dedup,
    token_counts,
    token_files,
    topk,
    toxicity,
    url_filter,
)
from dayloom.llm.common import LOWER, UPPER, table, written
from dayloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


@query("op1_byte_bpe")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", F.size("bpe.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("bpe.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bpe.decoded", 256).alias("decoded_sha256"),
    )


@query("op2_quality_rules")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "quality.*")


#: Words of a whole text, in DuckDB.
SQL_WORDS = r"len(regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+'))"
SQL_PARTS = r"len(regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D.,;:!?]+|[.,;:!?]'))"

OP3_SQL = f"""
WITH first_copy AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY text),
poor AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 0),
kept AS (
  SELECT d.*, p.doc_id IS NOT NULL AS is_poor
  FROM documents d JOIN first_copy USING (doc_id) LEFT JOIN poor p ON d.doc_id = p.doc_id),
counted AS (
  SELECT source, lang, 'words-1' AS tokenizer,
         CASE WHEN is_poor THEN {SQL_WORDS.format("regexp_replace(text, '[#*$%&|<>]+', ' ', 'g')")}
              ELSE {SQL_WORDS.format('text')} END AS n FROM kept
  UNION ALL
  SELECT source, lang, 'words-2', {SQL_PARTS.format('text')} FROM kept)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM counted GROUP BY ALL
"""


#: A text that one row in so many holds is joined apart from the others.
HOT_PART = 1000


@query("op3_token_counts", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Four batches over all documents: counts, a second tokenizer, revisions, deletes.

    Revised: documents labelled poor, counted again without symbol characters. Deleted: all
    copies of a text but the first. The last batch comes twice, as after a lost answer.
    """
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "token-rollup"))

    def changes(rows: DataFrame, version: str, tokens, op: str = "set") -> DataFrame:
        return rows.select("doc_id", F.lit(version).alias("tokenizer"), "source", "lang", tokens.alias("tokens"),
                           F.lit(op).alias("op"), F.lit(0).alias("seq"))

    for batch, version in enumerate(token_counts.TOKENIZERS):
        rollup.apply(batch, changes(docs, version, token_counts.count_tokens(F.col("text"), version)))

    # Counted where the texts are read: only ids and counts meet the labels.
    poor = table(spark, folder, "labels").where("quality = 0").select("doc_id").distinct()
    plain = F.regexp_replace("text", "[#*$%&|<>]+", " ")
    revised = changes(docs, "words-1", token_counts.count_tokens(plain, "words-1"))
    rollup.apply(2, revised.join(poor, "doc_id").select(revised.columns))

    marked = written(docs.select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"),
                                 F.col("text").isNull().alias("none")), "text-digests")
    first = written(marked.groupBy("digest", "none").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1"), "first-ids")
    # Texts of one row in HOT_PART or more are fewer than HOT_PART, and rows of theirs need no shuffle.
    total = marked.agg(F.count("*")).scalar()
    hot = F.broadcast(first.where(F.col("n") * HOT_PART >= total).drop("n"))
    rest = marked.join(hot, ["digest", "none"], "left_anti").join(first.drop("n"), ["digest", "none"])
    copies = marked.join(hot, ["digest", "none"]).select(rest.columns).unionByName(rest).where("doc_id > first_id")
    gone = [changes(copies, version, F.lit(None).cast("long"), "delete") for version in token_counts.TOKENIZERS]
    for _ in range(2):
        rollup.apply(3, gone[0].unionByName(gone[1]))
    return rollup.totals()


@query("op4_mixing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

OP5_SQL = rf"""
WITH parts AS (
  SELECT row_number() OVER () AS r, page_id,
         lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)) AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(h, p, v) AS (VALUES {RULES_SQL}),
best AS (
  SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (r)
"""


@query("op5_url_filter", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), url_filter.rules_frame(spark, RULES))


SQL_ESCAPED = r"regexp_replace(replace({0}, '\', '\\'), '(<|\[)(s>|/s>|INST\]|/INST\])', '\1\\\2', 'g')"
OP7_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
turns AS (
  SELECT *, {SQL_ESCAPED.format('role')} AS r, {SQL_ESCAPED.format('text')} AS t,
         role IS DISTINCT FROM lag(role) OVER w AS first FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
told AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length(t) + 13 + CASE WHEN first THEN 7 + length(r) ELSE 0 END) AS formatted
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted AS BIGINT) AS formatted_chars
FROM told
"""


@query("op7_chat_format", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    chats = chat_format.format_chats(rows)
    back = chats.select(
        "conv_id", chat_format.read_chats(F.col("formatted")).alias("turns"),
        chat_format.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), F.length("formatted").alias("n"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.col("n").cast("long").alias("formatted_chars"),
    )


OP8_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op8_top_k", OP8_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    vectors = written(topk.integer_vectors(table(spark, folder, "embeddings"), one_each=False), "vectors")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


@query("op9_token_files")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(
        table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end=2, added_tokens=True
    )
    return token_files.document_digests(spark, path)


SQL_LIST = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
OP10_SQL = f"""
WITH texts AS (SELECT doc_id, {SQL_LIST.format("text")} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM texts)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
spots AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
kept AS (
  SELECT doc_id, count(g.i) AS removed, string_agg(word, ' ' ORDER BY s.i) FILTER (g.i IS NULL) AS text
  FROM spots s LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


@query("op10_substring_dedup", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    left = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return left.select("doc_id", "dedup.n_words", "dedup.n_removed", F.sha2("dedup.kept", 256).alias("kept_sha256"))


OP6_SQL = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, {SQL_LIST.format(f"translate(text, '{UPPER}', '{LOWER}')")} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM texts),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n + y.n) AS total, count(*) AS shared
  FROM items x JOIN items y ON x.g = y.g AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n) GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs WHERE 100 * shared >= 90 * (total - shared) UNION ALL SELECT b, a FROM pairs WHERE 100 * shared >= 90 * (total - shared)),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(min(other), doc_id) AS component_id
FROM sets JOIN reach USING (doc_id) GROUP BY doc_id, s
"""


@query("op6_jaccard_join", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    linked = jaccard_join.near_duplicates(table(spark, folder, "documents"), size=3, percent=90)
    return linked.select("doc_id", "n_shingles", "component_id")


@query("op11_toxicity")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fold = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 5
    model = toxicity.fit(docs, table(spark, folder, "labels"), learn=fold("_id") != 0)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


#: CRC-32 in SQL: the table of its fixed polynomial, and the fold over the bytes of a number's decimal text.
SQL_CRC_TABLE = """list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))"""
SQL_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
  lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])))"""
#: Levels that the SQL spells out: enough for 8^7 rows of a language and 8^3 languages.
SQL_LEVELS, SQL_TOP_LEVELS = 7, 3


def _sql_levels(name: str, count: int) -> str:
    """Nodes of each level with their siblings, from the nodes ``{name}0``; a tree of one node stays as it is."""
    out = []
    for k in range(count):
        run = "PARTITION BY tree, idx // 8 ORDER BY idx ROWS BETWEEN"
        out.append(f"""
        {name}_s{k} AS (
          SELECT *, count(*) OVER (PARTITION BY tree) AS n,
                 coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
                 coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM {name}{k}),
        {name}{k + 1} AS (
          SELECT tree, idx // 8 AS idx, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE any_value(h) END AS h
          FROM {name}_s{k} GROUP BY tree, idx // 8)""")
    return ",".join(out)


def _sql_fold(name: str, start: str, count: int, rows: str, tree: str, idx: str) -> str:
    """Adds ``cur`` and ``proof`` of each row, level by level."""
    out, last = [], start
    for k in range(count):
        now = f"{rows}_{k}"
        out.append(f"""
        {now} AS (
          SELECT f.* REPLACE (CASE WHEN s.n > 1 THEN sha256(s.lft || cur || s.rgt) ELSE cur END AS cur,
                              CASE WHEN s.n > 1 THEN proof || s.lft || s.rgt ELSE proof END AS proof)
          FROM {last} f JOIN {name}_s{k} s ON s.tree = f.{tree} AND s.idx = f.{idx} // {8**k})""")
        last = now
    return ",".join(out)


def _sql_field(name: str, value: str | None = None) -> str:
    value = value or f"CAST({name} AS VARCHAR)"
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


_SQL_LOW = f"translate(text, '{UPPER}', '{LOWER}')"
_SQL_LEAF = " || ".join(_sql_field(f) for f in merkle.FIELDS)
_SQL_ALTERED = " || ".join(_sql_field(f, _SQL_LOW if f == "text" else None) for f in merkle.FIELDS)
OP12_SQL = f"""
WITH hashed AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, sha256({_SQL_LEAF}) AS leaf,
         CASE WHEN {SQL_CRC} % 3 = 0 THEN sha256({_SQL_ALTERED}) ELSE sha256({_SQL_LEAF}) END AS cur
  FROM documents, (SELECT {SQL_CRC_TABLE} AS crc)),
told AS (
  SELECT *, '' AS proof, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, cur) - 1 AS idx FROM hashed),
a0 AS (SELECT tree, idx, leaf AS h FROM told),{_sql_levels("a", SQL_LEVELS)},
subroots AS (SELECT tree AS lang, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM a{SQL_LEVELS}),
b0 AS (SELECT '' AS tree, place AS idx, subroot AS h FROM subroots),{_sql_levels("b", SQL_TOP_LEVELS)},
{_sql_fold("a", "told", SQL_LEVELS, "up", "tree", "idx")},
placed AS (SELECT u.*, subroot, place, '' AS whole FROM up_{SQL_LEVELS - 1} u JOIN subroots s ON s.lang = u.tree),
{_sql_fold("b", "placed", SQL_TOP_LEVELS, "over", "whole", "place")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM over_{SQL_TOP_LEVELS - 1}, (SELECT h AS root FROM b{SQL_TOP_LEVELS})
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    told = merkle.manifest(table(spark, folder, "documents"), tampered)
    return told.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


OP13_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
spots AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM spots, (VALUES (1), (2), (3)) t(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS s FROM f WHERE k > 1 AND f >= 10),
longer AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, array_to_string(s[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
    UNION ALL SELECT lang, array_to_string(s[2:3], ' '), a FROM candidates WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN longer m ON m.lang = c.lang AND m.phrase = c.phrase AND c.k = 2
  WHERE most IS NULL OR 100 * most < 50 * a),
cuts AS (
  SELECT c.lang, c.phrase, a, j, l.f AS l, r.f AS r, CAST((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept) c
  JOIN f l ON l.lang = c.lang AND l.k = j AND l.phrase = array_to_string(s[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.k = c.k - j AND r.phrase = array_to_string(s[j + 1:c.k], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM ranked JOIN (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY 1) USING (lang) WHERE rank <= 2000
"""


@query("op13_collocations", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))
