"""The operators as queries over the test tables, and their SQL for DuckDB where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, exact_dedup, language, licenses, mixing, piece_fst, prefix_trie, simhash, surrogates, token_store,
    vector_dedup, whitening, winnowing,
)
from .common import scratch, small_batches, space


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_surrogates(spark: SparkSession, folder: str, key: bytes = b"a secret of the deployment") -> DataFrame:
    done = surrogates.replace_entities(table(spark, folder, "documents"), key)
    return done.select("doc_id", "text", "entities", F.array_join("kinds", ",").alias("kinds"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    decided = exact_dedup.exact_dedup(table(spark, folder, "documents"), F.col("_metadata.file_path"))
    return decided.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_token_store(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    path = scratch(spark, "token_store")
    token_store.write_store(table(spark, folder, "documents"), tokenizer, path)
    with small_batches(spark, 1):
        return space(spark, "token_store").write(token_store.read_store(spark, path), "read")


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learned = ~language.held_out()
    samples = language.fit(docs, learned)
    limit = language.foreign_rate(docs, samples, learned)
    found = language.identify(docs.select("doc_id", "text"), samples)
    # Written while the batches are small: a batch of very long texts would be large.
    with small_batches(spark):
        return space(spark, "language").write(
            found.select(
                "doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rate", language.is_foreign(limit).alias("foreign")
            ),
            "predicted",
        )


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.mixing_plan(table(spark, folder, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op7_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(chat.write_examples(turns))


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), "license_sentences")


def op10_sentencepiece(spark: SparkSession, folder: str, model: str | None = None) -> DataFrame:
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_fst.round_trip(table(spark, folder, "documents"), model)


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    conv = F.col("conv_id")
    head = (F.crc32(conv.cast("string")) % 4).cast("int")
    return prefix_trie.shared_prefixes(table(spark, folder, "conversations"), head, conv - conv % 20, most=3)


def op12_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.edited_likeness(table(spark, folder, "documents")).select(
        "row.doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.written("own").alias("fingerprint"),
        winnowing.written("changed").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return whitening.by_component(vectors, whitening.fit(vectors))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (op1_surrogates, op2_exact_dedup, op3_token_store, op4_language, op5_mixing, op6_simhash, op7_vector_dedup, op8_chat, op9_licenses, op10_sentencepiece, op11_prefix_trie, op12_winnowing, op13_whitening)
}

SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT"

SQL: dict[str, str] = {
    "op2_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)""",
    "op5_mixing": rf"""
WITH docs AS (SELECT doc_id, source, {SIZE} AS size, md5(coalesce(text, '')) AS digest FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM src),
summed AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(source_size) OVER b, 0) AS size_before, coalesce(sum(weight) OVER b, 0) AS weight_before,
         row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS place
  FROM weighed
  WINDOW b AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (total::DOUBLE - 3.0::DOUBLE * size_before::DOUBLE) / (weights - weight_before)::DOUBLE AS level FROM summed),
share AS (SELECT arg_min(level, place) AS share FROM levels WHERE 3.0::DOUBLE * source_size >= level * weight),
targets AS (
  SELECT source, source_size,
         CASE WHEN source_size > 0 THEN least(3.0::DOUBLE * source_size, share * weight) ELSE 0.0::DOUBLE END AS target
  FROM levels, share),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets),
drawn AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.rate,
         ('0x' || substr(md5('mix|' || coalesce(d.doc_id::VARCHAR, '') || '|' || d.digest), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM docs d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source),
counted AS (SELECT *, (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM drawn)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM counted""",
    "op8_chat": r"""
WITH own AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
placed AS (
  SELECT *, replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS erole,
         replace(replace(text, '\', '\\'), '<|', '<\|') AS etext,
         row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n
  FROM own WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
laid AS (SELECT *, length(erole) + length(etext) + 17 AS chars FROM placed),
ended AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY pos) AS stop FROM laid)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(stop) FILTER (role = 'assistant' OR pos = n)::BIGINT AS formatted_chars
FROM ended GROUP BY conv_id""",
}


def _license_sql() -> str:
    quoted = lambda names: "[" + ", ".join(f"'{s}'" for s in names) + "]"
    known, spdx = quoted(licenses.SENTENCES.values()), quoted(name.lower() for name in licenses.SPDX)
    bare = "lower(coalesce(text, ''))"
    for pattern, to in licenses.STEPS:
        bare = f"regexp_replace({bare}, '{pattern}', '{to.format('', chr(92) + '1', chr(92) + '2')}', 'g')"
    cuts = {"l": licenses.LINE_ENDS, "f": licenses.WRAPPED_ENDS}
    parts = ",\n".join(
        rf"""regexp_replace(',' || array_to_string(list_transform(list_filter(list_transform(
      string_split(regexp_replace(regexp_replace(bare, '{ends}', chr(1), 'g'), '[^a-z0-9.\x01]+', ' ', 'g'), chr(1)),
      lambda s: trim(s, ' .')), lambda s: s <> ''),
      lambda s: coalesce(list_position({known}, s), 0)), ',') || ',', '(,0)+,', ',0,', 'g') AS {name}"""
        for name, ends in cuts.items()
    )
    words = f"flatten(list_transform(regexp_extract_all(bare, '{licenses.TAG}', 1), lambda t: regexp_split_to_array(t, '{licenses.TAG_WORDS}')))"
    named = f"list_filter(list_transform({words}, lambda w: coalesce(list_position({spdx}, w), 0)), lambda n: n > 0)"
    parts += f""",
'0,' || coalesce(array_to_string(list_transform({named}, lambda n: (n + {len(licenses.SENTENCES)})::VARCHAR || ',0,'), ''), '') AS g"""
    steps, last = [f"r0 AS (SELECT doc_id, l, f, g, l || '0' || f || g AS seq, []::VARCHAR[] AS names FROM cut)"], 0
    for k, (name, seq) in enumerate(licenses.RULES + licenses.TAG_RULES, 1):
        rule = "," + ",".join(str(licenses.NUMBER[s]) for s in seq) + ","
        steps.append(
            f"r{k} AS (SELECT doc_id, l, f, g, replace(seq, '{rule}', ',0,') AS seq, "
            f"CASE WHEN contains(seq, '{rule}') THEN list_append(names, '{name}') ELSE names END AS names FROM r{last})"
        )
        last = k
    rules = ",\n".join(steps)
    unique = "list_filter(names, lambda x, i: list_position(names, x) = i)"
    count = "len(regexp_extract_all({}, '[1-9][0-9]*'))"
    return f"""WITH bared AS (SELECT doc_id, {bare} AS bare FROM documents),
cut AS (SELECT doc_id, {parts} FROM bared),
{rules}
SELECT doc_id, coalesce(array_to_string({unique}, ','), '') AS licenses,
       (greatest({count.format('l')}, {count.format('f')}) + {count.format('g')})::BIGINT AS license_sentences FROM r{last}"""


SQL["op9_licenses"] = _license_sql()

#: The table of CRC-32 (reflected polynomial 0xEDB88320), built bit by bit.
CRC_TABLE = """tab AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END)) AS crc)"""


def _crc(numbers: str) -> str:
    """CRC-32 of a list of byte values."""
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {numbers}), "
        "lambda x, b: xor(x >> 8, tab.crc[(xor(x, b) & 255) + 1])), 4294967295)"
    )


SQL["op11_prefix_trie"] = f"""
WITH {CRC_TABLE},
t AS (SELECT conv_id, turn, coalesce(text, '') AS text,
             sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key
      FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos FROM t),
ids AS (SELECT DISTINCT conv_id AS c FROM t),
convs AS (SELECT c, {_crc("list_transform(string_split(c::VARCHAR, ''), lambda d: unicode(d)::BIGINT)")} % 4 AS h FROM ids, tab),
rebuilt AS (
  SELECT c, 0 AS part, pos, key, words FROM convs JOIN placed ON conv_id = c - c % 20 AND pos <= h
  UNION ALL SELECT c, 1, pos, key, words FROM convs JOIN placed ON conv_id = c AND pos > h),
numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d FROM rebuilt),
paths AS (SELECT c, d, words, string_agg(key, '') OVER (PARTITION BY c ORDER BY d) AS path FROM numbered
          UNION ALL SELECT c, 0, 0, '' FROM convs),
nodes AS (SELECT path, any_value(d) AS d, any_value(words) AS words, min(c) AS conv_id, count(*) AS n FROM paths GROUP BY path),
children AS (SELECT left(path, (64 * (d - 1))::INT) AS path, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1),
own AS (SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN children USING (path)),
above AS (SELECT left(path, (64 * up)::INT) AS path, k, n, words FROM (SELECT *, unnest(range(d + 1)) AS up FROM own)),
sums AS (SELECT path, sum((k = 0)::INT) AS leaves, sum((n - 1) * words) AS saved FROM above GROUP BY path),
last AS (SELECT c, arg_max(path, d) AS path FROM paths GROUP BY c),
ends AS (SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM last GROUP BY path)
SELECT o.conv_id, o.d::BIGINT AS depth, p.conv_id AS parent_conv_id, o.n AS n_convs, o.k AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM own o JOIN sums s USING (path) LEFT JOIN ends e USING (path)
LEFT JOIN nodes p ON o.d > 0 AND p.path = left(o.path, (64 * (o.d - 1))::INT)"""


def _winnowing_sql() -> str:
    gram, window, places = winnowing.GRAM, winnowing.WINDOW, winnowing.PLACES
    # The four bytes of a code point; a CRC is shifted by m bytes through tables of its own four.
    four = lambda c: f"[{c} >> 24, ({c} >> 16) & 255, ({c} >> 8) & 255, {c} & 255]"
    steps, width = [], 1
    while width < gram:
        joins = " ".join(f"JOIN s{width} t{k} ON t{k}.j = {256 * k} + ((h >> {8 * k}) & 255)" for k in range(4))
        steps.append(f"""s{width} AS (
  SELECT j, list_reduce(list_prepend((j & 255) << (8 * (j >> 8)), range({4 * width})),
                        lambda x, i: xor(x >> 8, tab.crc[(x & 255) + 1])) AS v FROM (SELECT unnest(range(1024)) AS j), tab),
g{2 * width} AS (
  SELECT key, pos, n, xor(xor(xor(t0.v, t1.v), xor(t2.v, t3.v)), following) AS h
  FROM (SELECT *, lead(h, {width}) OVER (PARTITION BY key ORDER BY pos) AS following FROM g{width}) {joins})""")
        width *= 2
    return f"""
WITH {CRC_TABLE},
docs AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
ring AS (SELECT *, coalesce(lead(doc_id) OVER w, first(doc_id) OVER w) AS next_id, coalesce(lead(text) OVER w, first(text) OVER w) AS next_text
         FROM docs WINDOW w AS (ORDER BY doc_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edits AS (SELECT *, left(text, n - n // 2) || left(next_text, n // 2) AS edited FROM ring),
texts AS (SELECT 'o' || doc_id AS key, text, length(text) AS n FROM edits UNION ALL SELECT 'e' || doc_id, edited, length(edited) FROM edits),
chars AS (SELECT key, n, unnest(range(n)) AS pos, unnest(list_transform(regexp_extract_all(text, '(?s).'), lambda c: unicode(c)::BIGINT)) AS code
          FROM texts),
codes AS (SELECT code, {_crc(four("code"))} AS h FROM (SELECT DISTINCT code FROM chars), tab),
g1 AS (SELECT key, pos, n, h FROM chars JOIN codes USING (code)),
{", ".join(steps)},
placed AS (SELECT key, pos, n, h * {places} + ({places - 1} - pos) AS v FROM g{gram} WHERE pos <= n - {gram}),
windows AS (SELECT key, pos, n, min(v) OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING) AS v FROM placed),
chosen AS (SELECT DISTINCT key, v FROM windows WHERE pos = 0 OR pos <= n - {gram + window - 1}),
short AS (SELECT key, {_crc("flatten(list_transform(regexp_extract_all(text, '(?s).'), lambda c: " + four("unicode(c)::BIGINT") + "))")} AS h
          FROM texts, tab WHERE n BETWEEN 1 AND {gram - 1}),
lists AS (SELECT key, list(v >> 31 ORDER BY {places - 1} - (v & {places - 1})) AS hs FROM chosen GROUP BY key UNION ALL SELECT key, [h] FROM short),
prints AS (SELECT key, coalesce(hs, []) AS hs FROM texts LEFT JOIN lists USING (key))
SELECT d.doc_id, d.n AS n_chars, sha256(d.edited) AS edited_sha256,
       {_hex("o.hs")} AS fingerprint, {_hex("e.hs")} AS edited_fingerprint,
       {_likeness("o.hs", "e.hs")} AS near_edited, {_likeness("o.hs", "f.hs")} AS near_next
FROM edits d JOIN prints o ON o.key = 'o' || d.doc_id JOIN prints e ON e.key = 'e' || d.doc_id JOIN prints f ON f.key = 'o' || d.next_id"""


def _hex(values: str) -> str:
    return f"coalesce(array_to_string(list_transform({values}, lambda x: lower(to_hex(x))), ' '), '')"


def _likeness(a: str, b: str) -> str:
    every = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {every} = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / {every} END"


SQL["op12_winnowing"] = _winnowing_sql()
