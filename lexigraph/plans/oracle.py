"""The same queries as DuckDB SQL, assembled from named common table expressions.

Each CTE is written from the definition of its operator, with joins, windows and plain
aggregates where the Spark side uses arrays.
"""

from __future__ import annotations

import re

from ..functions import stopwords

# Fixed values of the result lists, written here again rather than taken from the engine.
SEARCH_RESULTS, NOTEBOOK_RESULTS, FUSED_DIGITS = 30, 100, 10
VIEW_MONTH = "2024-01-01"
AVGDL = "341.0890174848911::DOUBLE"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *needs: str) -> str:
    CTES[name] = (sql, needs)
    return name


def sql_of(final: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for n in CTES[name][1]:
                add(n)
            order.append(name)

    for n in needs:
        add(n)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + final


def in_list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


ENGLISH = in_list(stopwords.ENGLISH)
ALL = in_list(stopwords.ALL)


def pattern(min_chars: int) -> str:
    return rf"[#@\p{{L}}\p{{N}}_](?:[''\-]?[\p{{L}}\p{{N}}_]){{{min_chars - 1},24}}"


# Porter's steps over a word list


_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_M0 = f"^({_C})?{_V}{_C}"
_M1 = f"^({_C})?{_V}{_C}({_V})?$"
_M2 = f"^({_C})?{_V}{_C}{_V}{_C}"
_HAS_V = f"^({_C})?[aeiouy]"
_O = f"^{_C}[aeiouy][^aeiouwxy]$"
_DOUBLE = "(" + "|".join(2 * c for c in "bcdfghjkmnpqrtvwx") + ")$"

_STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
_STEP3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
_STEP4 = (
    "al ance ence er ic able ible ant ement ment ent sion tion ou ism ate iti ous ive ize".split()
)


def _is(text: str, rx: str) -> str:
    return f"regexp_matches({text}, '{rx}')"


def _cut(n: int) -> str:
    return f"left(s, length(s) - {n})"


def _table(rules, condition) -> str:
    whens = []
    for suffix in sorted(rules, key=len, reverse=True):
        n, new = (3, "") if suffix in ("sion", "tion") and not isinstance(rules, dict) else (
            len(suffix), rules[suffix] if isinstance(rules, dict) else ""
        )
        whens.append(
            f"WHEN ends_with(s, '{suffix}') THEN CASE WHEN {_is(_cut(n), condition)} "
            f"THEN {_cut(n)} || '{new}' ELSE s END"
        )
    return "CASE " + " ".join(whens) + " ELSE s END"


_IRREGULAR = (
    "CASE word WHEN 'skies' THEN 'sky' WHEN 'dying' THEN 'die' WHEN 'lying' THEN 'lie' "
    "WHEN 'tying' THEN 'tie' WHEN 'innings' THEN 'inning' WHEN 'outings' THEN 'outing' "
    "WHEN 'cannings' THEN 'canning' ELSE word END"
)
_AS_THEY_ARE = (
    "('sky', 'skies', 'dying', 'lying', 'tying', 'news', 'innings', 'inning', 'outings', 'outing', "
    "'cannings', 'canning', 'howe', 'proceed', 'exceed', 'succeed')"
)


def extend(steps: list[str]) -> list[str]:
    """The toolkit's variant of the nine steps."""
    plural, past, repair, _, step2, step3, step4, final_e, final_ll = steps
    short = "^([aeiou][^aeiou]|" + _O[1:-1] + ")$"
    rules = {k: v for k, v in _STEP2.items() if k != "abli"} | {"bli": "ble", "fulli": "ful", "logi": "log"}
    return [
        f"CASE WHEN length(s) = 4 AND ends_with(s, 'ies') THEN {_cut(1)} ELSE {plural} END",
        f"CASE WHEN ends_with(s, 'ied') THEN CASE WHEN length(s) = 4 THEN {_cut(1)} ELSE {_cut(2)} END "
        f"ELSE {past} END",
        repair.replace(_O, short),
        f"CASE WHEN length(s) > 2 AND {_is('s', '([^aeiouy]|[aeiou]y)y$')} THEN {_cut(1)} || 'i' ELSE s END",
        f"CASE WHEN ends_with(s, 'alli') AND {_is(_cut(4), _M0)} THEN {_cut(2)} ELSE s END",
        # The measure of -logi is taken with its l.
        _table(rules, _M0).replace(
            f"'logi') THEN CASE WHEN {_is(_cut(4), _M0)}", f"'logi') THEN CASE WHEN {_is(_cut(3), _M0)}"
        ),
        step3,
        step4,
        final_e.replace(_O, short),
        final_ll,
    ]


def stems(name: str, source: str, extended: bool = False) -> None:
    """CTE ``name(word, stem)`` over the distinct ``term`` of CTE ``source``."""
    steps = [
        "CASE WHEN ends_with(s, 'sses') OR ends_with(s, 'ies') THEN " + _cut(2)
        + f" WHEN ends_with(s, 'ss') THEN s WHEN ends_with(s, 's') THEN {_cut(1)} ELSE s END",
        f"CASE WHEN ends_with(s, 'eed') THEN CASE WHEN {_is(_cut(3), _M0)} THEN {_cut(1)} ELSE s END "
        f"WHEN ends_with(s, 'ed') THEN CASE WHEN {_is(_cut(2), _HAS_V)} THEN {_cut(2)} || '|' ELSE s END "
        f"WHEN ends_with(s, 'ing') THEN CASE WHEN {_is(_cut(3), _HAS_V)} THEN {_cut(3)} || '|' ELSE s END "
        "ELSE s END",
        f"CASE WHEN NOT ends_with(s, '|') THEN s WHEN {_is(_cut(1), '(at|bl|iz)$')} THEN {_cut(1)} || 'e' "
        f"WHEN {_is(_cut(1), _DOUBLE)} THEN {_cut(2)} WHEN {_is(_cut(1), _O)} THEN {_cut(1)} || 'e' "
        f"ELSE {_cut(1)} END",
        f"CASE WHEN ends_with(s, 'y') AND {_is(_cut(1), _HAS_V)} THEN {_cut(1)} || 'i' ELSE s END",
        _table(_STEP2, _M0),
        _table(_STEP3, _M0),
        _table(_STEP4, _M2),
        f"CASE WHEN ends_with(s, 'e') AND ({_is(_cut(1), _M2)} OR ({_is(_cut(1), _M1)} "
        f"AND NOT {_is(_cut(1), _O)})) THEN {_cut(1)} ELSE s END",
        f"CASE WHEN ends_with(s, 'll') AND {_is(_cut(1), _M2)} THEN {_cut(1)} ELSE s END",
    ]
    steps = extend(steps) if extended else steps
    before = cte(
        f"{name}_0", f"SELECT word, word AS s FROM (SELECT DISTINCT term AS word FROM {source})", source
    )
    for i, step in enumerate(steps, 1):
        before = cte(f"{name}_{i}", f"SELECT word, {step} AS s FROM {before}", before)
    cte(
        name,
        f"SELECT word, CASE WHEN length(word) < 3 THEN word "
        + (f"WHEN word IN {_AS_THEY_ARE} THEN {_IRREGULAR} " if extended else "")
        + f"ELSE s END AS stem FROM {before}",
        before,
    )


# Corpus


cte(
    "docs",
    "SELECT doc_id AS id, regexp_extract(text, '^[^.!?\\n]*', 0) AS title, text, source, n_chars "
    "FROM documents",
)
cte(
    "links",
    f"""
    SELECT l.id AS src, t.id AS dst, t.title AS text
    FROM docs l JOIN docs t ON t.id = (l.id * 7 + 3) % (SELECT count(*) FROM documents)
    UNION ALL
    SELECT l.id, h.id, concat_ws(' ', l.source, h.title)
    FROM docs l
    JOIN (SELECT source, min(id) AS home FROM docs GROUP BY source) m ON l.source = m.source
    JOIN docs h ON h.id = m.home""",
    "docs",
)
cte("title_field", "SELECT id AS doc_id, title AS text FROM docs", "docs")
cte("body_field", "SELECT id AS doc_id, text FROM docs", "docs")
# Each page's incoming anchors joined into one text.
cte(
    "anchor_field",
    "SELECT dst AS doc_id, string_agg(text, ' ') AS text FROM links GROUP BY dst",
    "links",
)
cte(
    "query_field",
    """
    SELECT item_id * 2 AS doc_id, text FROM benchmark
    UNION ALL
    SELECT item_id * 2 + 1, word FROM (
      SELECT item_id, word, row_number() OVER (PARTITION BY item_id ORDER BY length(word) DESC, word DESC) AS r
      FROM (SELECT item_id, unnest(regexp_split_to_array(text, '\\s+')) AS word FROM benchmark)
    ) WHERE r = 1""",
)


# Analysis: <field>_tok<n> raw tokens, <field>_kept<n> after stop words, <field>_stem<n> stemmed


def analysis(field: str, n: int) -> None:
    cte(
        f"{field}_tok{n}",
        f"""
        SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS term
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '{pattern(n)}') AS w FROM {field}_field)""",
        f"{field}_field",
    )
    cte(
        f"{field}_kept{n}",
        f"""
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS pos, term
        FROM {field}_tok{n} WHERE term NOT IN {ENGLISH}""",
        f"{field}_tok{n}",
    )
    stems(f"{field}_vocab{n}", f"{field}_kept{n}")
    cte(
        f"{field}_stem{n}",
        f"SELECT doc_id, pos, stem AS term FROM {field}_kept{n} JOIN {field}_vocab{n} ON term = word",
        f"{field}_kept{n}",
        f"{field}_vocab{n}",
    )
    cte(
        f"{field}_gram{n}",
        f"""
        SELECT doc_id, term || ' ' || next AS term FROM (
          SELECT doc_id, term, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS next
          FROM {field}_stem{n}) WHERE next IS NOT NULL""",
        f"{field}_stem{n}",
    )


for _field in ("title", "body", "anchor", "query"):
    for _n in (2, 3):
        analysis(_field, _n)


# Every distinct word of the bodies, stop words included.
stems("whole_vocab", "body_tok2")
stems("extended_vocab", "body_tok2", extended=True)


# Indexes: <name>_tf, <name>_df, <name>_post; <field>_len


def inverted(name: str, source: str, min_df: int, drop_stop_words: bool) -> None:
    where = f"WHERE term NOT IN {ALL}" if drop_stop_words else ""
    cte(
        f"{name}_tf",
        f"SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf FROM {source} {where} GROUP BY ALL",
        source,
    )
    cte(
        f"{name}_df",
        f"SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM {name}_tf GROUP BY term",
        f"{name}_tf",
    )
    cte(
        f"{name}_post",
        f"SELECT term, doc_id, tf, df FROM {name}_tf JOIN {name}_df USING (term) WHERE df > {min_df}",
        f"{name}_tf",
        f"{name}_df",
    )


inverted("title", "title_stem3", 0, True)
inverted("title_grams", "title_gram3", 0, False)
inverted("title_words", "title_kept3", 0, True)
inverted("body", "body_stem3", 20, True)
inverted("body_all", "body_stem3", 0, True)
inverted("body_grams", "body_gram3", 20, False)
inverted("body_words", "body_kept3", 20, True)
inverted("anchor", "anchor_stem3", 0, True)
inverted("anchor_words", "anchor_kept3", 0, True)

for _field in ("title", "body", "anchor"):
    cte(
        f"{_field}_len",
        f"""
        SELECT id AS doc_id, CAST(count(pos) AS INTEGER) AS doc_len
        FROM docs LEFT JOIN {_field}_kept3 ON id = doc_id GROUP BY id""",
        "docs",
        f"{_field}_kept3",
    )

N = "(SELECT count(*) FROM documents)"
IDF = f"log2({N} / df)"

cte(
    "raw_title",
    "SELECT id AS doc_id, len(string_split(regexp_replace(title, '[^\\p{L}\\p{N}_]', ' ', 'g'), ' ')) AS raw_words "
    "FROM docs",
    "docs",
)
for _name in ("body", "body_words"):
    cte(
        f"{_name}_norm",
        f"""
        SELECT doc_id, sum(pow(tf / doc_len * {IDF}, 2)) AS norm2
        FROM {_name}_post JOIN body_len USING (doc_id) GROUP BY doc_id""",
        f"{_name}_post",
        "body_len",
    )


# Queries


cte(
    "q_terms",
    "SELECT doc_id AS query_id, term, CAST(count(*) AS INTEGER) AS qtf FROM query_stem2 GROUP BY ALL",
    "query_stem2",
)
cte("q_counted", f"SELECT * FROM q_terms WHERE term NOT IN {ALL}", "q_terms")
cte("q_info", "SELECT query_id, sum(qtf) AS n_tokens FROM q_terms GROUP BY ALL", "q_terms")
cte("q_chars", "SELECT doc_id AS query_id, length(text) AS n_chars FROM query_field", "query_field")
cte("q_square", "SELECT query_id, sum(qtf * qtf) AS square FROM q_counted GROUP BY query_id", "q_counted")
cte("q_grams", "SELECT DISTINCT doc_id AS query_id, term FROM query_gram2", "query_gram2")
cte(
    "q_words",
    f"""
    SELECT doc_id AS query_id, term, CAST(count(*) AS INTEGER) AS qtf
    FROM query_kept3 WHERE term NOT IN {ALL} GROUP BY ALL""",
    "query_kept3",
)


# Result lists: <list>_raw(query_id, doc_id, score), <list>(..., rank), scaled <list>_mm


def significant(x: str) -> str:
    """Twelve significant digits."""
    unit = f"pow(10.0::DOUBLE, floor(log10(abs({x}))))"
    return f"CASE WHEN {x} = 0 THEN 0.0::DOUBLE ELSE round({x} / {unit}, 11) * {unit} END"


def cut(source: str, k: int | None, by: str = "score", digits: int | None = None) -> str:
    key = significant(by) if digits is None else f"round({by}, {digits})"
    k = 1 << 60 if k is None else k
    return f"""
    SELECT * FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY {key} DESC, doc_id) AS INTEGER) AS rank
      FROM {source}) WHERE rank <= {k}"""


def scaled(name: str, zero: str = "0.0") -> None:
    cte(
        f"{name}_mm",
        f"""
        SELECT * EXCLUDE (score), CASE
          WHEN {significant("max(score) OVER w")} = {significant("min(score) OVER w")} THEN {zero}
          ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS score
        FROM {name} WINDOW w AS (PARTITION BY query_id)""",
        name,
    )


def result_list(name: str, k: int | None, raw: str, *needs: str) -> None:
    cte(f"{name}_raw", raw, *needs)
    cte(name, cut(f"{name}_raw", k), f"{name}_raw")
    scaled(name)


def bm25(name: str, post: str, lengths: str, avgdl: str | None = None, n: str = "", terms: str = "q_terms") -> None:
    mean, idf = avgdl or f"(SELECT avg(doc_len) FROM {lengths})", f"log2({n} / df)" if n else IDF
    result_list(
        name,
        100,
        f"""
        SELECT query_id, doc_id, sum(qtf * {idf} * (tf * 2.5)
          / (tf + 1.5 * (0.25 + 0.75 * doc_len / {mean}))) AS score
        FROM {terms} JOIN {post} USING (term) JOIN {lengths} USING (doc_id) GROUP BY ALL""",
        terms,
        post,
        lengths,
    )


bm25("bm25", "body_post", "body_len")
bm25("bm25_all", "body_all_post", "body_len")
bm25("bm25_fixed", "body_post", "body_len", AVGDL)

# Another build: bodies and pages, words of two letters on, no stop words.
_PLAIN_TEXT = (
    "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({}, '<[^>]*>', ' ', 'g'), "
    "'&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), "
    "'[ \\t\\r\\n]+', ' ', 'g'))"
)
cte(
    "other_field",
    f"""
    SELECT doc_id, text FROM documents
    UNION ALL
    SELECT -1 - page_id, {_PLAIN_TEXT.format("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")} FROM pages""",
)
cte(
    "other_tok",
    f"SELECT doc_id, unnest(regexp_extract_all(lower(text), '{pattern(2)}')) AS term FROM other_field",
    "other_field",
)
stems("other_vocab", "other_tok")
cte("other_stem", "SELECT doc_id, stem AS term FROM other_tok JOIN other_vocab ON term = word", "other_tok", "other_vocab")
cte("other_tf", "SELECT doc_id, term, count(*) AS tf FROM other_stem GROUP BY ALL", "other_stem")
cte("other_df", "SELECT term, count(*) AS df FROM other_tf GROUP BY term HAVING count(*) > 20", "other_tf")
cte(
    "other_len",
    "SELECT f.doc_id, count(s.term) AS doc_len FROM other_field f LEFT JOIN other_stem s USING (doc_id) GROUP BY ALL",
    "other_field", "other_stem",
)
OTHER_N = "(SELECT count(*) FROM other_field)"
cte(
    "other_norm",
    f"""
    SELECT doc_id, sum(pow(tf / doc_len * log2({OTHER_N} / df), 2)) AS norm2
    FROM other_tf JOIN other_df USING (term) JOIN other_len USING (doc_id) GROUP BY doc_id""",
    "other_tf", "other_df", "other_len", "other_field",
)
bm25("other_bm25", "body_post", "other_len", n=OTHER_N)
_WEIGHT = f"log2({OTHER_N} / df)"
result_list(
    "other_cosine",
    100,
    f"""
    SELECT query_id, doc_id, CASE WHEN max(square * norm2) > 0
      THEN sum((qtf / n_chars * {_WEIGHT}) * (tf / doc_len * {_WEIGHT})) / sqrt(max(square * norm2)) ELSE 0 END AS score
    FROM q_counted JOIN q_chars USING (query_id) JOIN q_square USING (query_id) JOIN body_post USING (term)
    JOIN other_len USING (doc_id) JOIN other_norm USING (doc_id) GROUP BY query_id, doc_id""",
    "q_counted", "q_chars", "q_square", "body_post", "other_len", "other_norm",
)
cte(
    "cosine_parts",
    f"""
    SELECT query_id, doc_id, sum((qtf / n_chars * {IDF}) * (tf / doc_len * {IDF})) AS dot
    FROM q_counted JOIN q_chars USING (query_id) JOIN body_post USING (term) JOIN body_len USING (doc_id)
    GROUP BY ALL""",
    "q_counted", "q_chars", "body_post", "body_len",
)
result_list(
    "cosine",
    100,
    """
    SELECT query_id, doc_id, CASE WHEN norm2 > 0 THEN dot / sqrt(square * norm2) ELSE 0 END AS score
    FROM cosine_parts JOIN q_square USING (query_id) JOIN body_norm USING (doc_id)""",
    "cosine_parts", "q_square", "body_norm",
)
result_list("dot_body", 100, "SELECT query_id, doc_id, dot AS score FROM cosine_parts", "cosine_parts")
result_list(
    "dot_title",
    100,
    f"""
    SELECT query_id, doc_id, sum((qtf / n_chars * {IDF}) * (tf / doc_len * {IDF})) AS score
    FROM q_counted JOIN q_chars USING (query_id) JOIN title_post USING (term) JOIN title_len USING (doc_id)
    GROUP BY ALL""",
    "q_counted", "q_chars", "title_post", "title_len",
)
result_list(
    "title_cov",
    150,
    """
    SELECT query_id, doc_id, sum(qtf * tf / raw_words) AS score
    FROM q_terms JOIN title_post USING (term) JOIN raw_title USING (doc_id) GROUP BY ALL""",
    "q_terms", "title_post", "raw_title",
)
cte("t2", "SELECT DISTINCT doc_id, term FROM title_gram2", "title_gram2")
result_list(
    "title_jac",
    150,
    """
    SELECT query_id, doc_id, sum(tf / (n_q + n_t - coalesce(n_both, 0))) AS score
    FROM q_grams JOIN title_grams_post USING (term)
    JOIN (SELECT query_id, count(*) AS n_q FROM q_grams GROUP BY ALL) USING (query_id)
    JOIN (SELECT doc_id, count(*) AS n_t FROM t2 GROUP BY ALL) USING (doc_id)
    LEFT JOIN (SELECT query_id, doc_id, count(*) AS n_both FROM q_grams JOIN t2 USING (term) GROUP BY ALL)
      USING (query_id, doc_id)
    GROUP BY query_id, doc_id""",
    "q_grams", "title_grams_post", "t2",
)
result_list(
    "anchor_cnt",
    150,
    """
    SELECT query_id, doc_id, CAST(sum(qtf * tf) AS DOUBLE) AS score
    FROM q_terms JOIN anchor_post USING (term) GROUP BY ALL""",
    "q_terms", "anchor_post",
)
cte(
    "body_2_count",
    """
    SELECT query_id, doc_id, sum(tf / doc_len) AS score, count(*) AS matched
    FROM q_grams JOIN body_grams_post USING (term) JOIN body_len USING (doc_id) GROUP BY ALL""",
    "q_grams", "body_grams_post", "body_len",
)
cte("body_2_first", cut("body_2_count", 150, "matched"), "body_2_count")
result_list("body_2", 100, "SELECT query_id, doc_id, score, matched FROM body_2_first", "body_2_first")
result_list(
    "body_cos",
    100,
    f"""
    SELECT query_id, doc_id, CASE WHEN max(query2) > 0 AND max(norm2) > 0
      THEN sum(qtf / n_words * {IDF} * (tf / doc_len * {IDF})) / (sqrt(max(query2)) * sqrt(max(norm2)))
      ELSE 0 END AS score
    FROM q_words
    JOIN (SELECT query_id, sum(qtf) AS n_words FROM q_words GROUP BY ALL) USING (query_id)
    JOIN body_words_post USING (term) JOIN body_len USING (doc_id) JOIN body_words_norm USING (doc_id)
    JOIN (
      SELECT query_id, sum(pow(qtf / n_words * {IDF}, 2)) AS query2
      FROM q_words JOIN (SELECT query_id, sum(qtf) AS n_words FROM q_words GROUP BY ALL) USING (query_id)
      JOIN body_words_df USING (term) WHERE df > 20 GROUP BY query_id) USING (query_id)
    GROUP BY query_id, doc_id""",
    "q_words", "body_words_post", "body_len", "body_words_norm", "body_words_df",
)
result_list(
    "view_scores",
    None,
    """
    SELECT date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS query_id,
      CAST(json_extract_string(props, '$.k') AS BIGINT) AS doc_id, CAST(count(*) AS DOUBLE) AS score
    FROM events GROUP BY ALL""",
)
cte(
    "view_scores_keep",
    f"""
    SELECT query_id, doc_id, rank, CASE
      WHEN {significant("max(score) OVER w")} = {significant("min(score) OVER w")} THEN score
      ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS score
    FROM view_scores WINDOW w AS (PARTITION BY query_id)""",
    "view_scores",
)


# Fusion


def fused(name: str, *weighted: tuple[str, str]) -> None:
    """A full outer sum, added in the order given."""
    parts = " UNION ALL ".join(
        f"SELECT query_id, doc_id, {i} AS list, {score} AS part FROM {source}"
        for i, (source, score) in enumerate(weighted)
    )
    total = " + ".join(
        f"coalesce(max(part) FILTER (WHERE list = {i}), 0)" for i in range(len(weighted))
    )
    cte(
        name,
        f"SELECT query_id, doc_id, {total} AS score FROM ({parts}) GROUP BY query_id, doc_id",
        *(source for source, _ in weighted),
    )


def times(weight: tuple[int, int]) -> str:
    return f"score * {weight[0]} / {weight[1]}"


fused(
    "f_one",
    ("title_cov_mm", times((10, 20))),
    ("anchor_cnt_mm", times((10, 20))),
)
fused(
    "f_base",
    ("title_cov_mm", times((7, 16))),
    ("bm25_mm", times((1, 16))),
    ("anchor_cnt_mm", times((7, 16))),
)
fused(
    "f_multi",
    ("f_base", times((1, 10))),
    ("title_jac_mm", times((9, 10))),
    ("body_2_mm", "1 / 10"),
)
fused(
    "f_notebook_raw",
    ("dot_title", times((7, 16))),
    ("dot_body", times((1, 16))),
)
cte("f_notebook", cut("f_notebook_raw", NOTEBOOK_RESULTS, digits=FUSED_DIGITS), "f_notebook_raw")
cte(
    "search_scores",
    """
    SELECT query_id, doc_id, score
    FROM f_one JOIN q_info USING (query_id) WHERE n_tokens = 1
    UNION ALL
    SELECT query_id, doc_id, score FROM f_multi JOIN q_info USING (query_id) WHERE n_tokens > 1""",
    "f_one", "f_multi", "q_info",
)
cte("found", cut("search_scores", SEARCH_RESULTS, digits=FUSED_DIGITS), "search_scores")


# Links


cte("edges", "SELECT DISTINCT src, dst FROM links", "links")
cte(
    "sink_edges",
    "SELECT DISTINCT src, dst FROM links JOIN documents ON src = doc_id WHERE length(documents.text) >= 1000",
    "links",
)
for _p in ("", "sink_"):
    cte(
        f"{_p}nodes",
        f"""
        SELECT id, count(src) AS outdeg
        FROM (SELECT src AS id FROM {_p}edges UNION SELECT dst FROM {_p}edges) LEFT JOIN {_p}edges ON src = id GROUP BY id""",
        f"{_p}edges",
    )
    cte(f"{_p}pr_0", f"SELECT id, outdeg, CAST(1.0 AS DOUBLE) AS r FROM {_p}nodes", f"{_p}nodes")
    for _i in range(1, 7):
        cte(
            f"{_p}pr_{_i}",
            f"""
            SELECT n.id, n.outdeg, 0.15 + 0.85 * coalesce(m.got, 0) AS r
            FROM {_p}nodes n LEFT JOIN (
              SELECT dst, sum(r / outdeg) AS got FROM {_p}edges JOIN {_p}pr_{_i - 1} ON src = id GROUP BY dst
            ) m ON n.id = m.dst""",
            f"{_p}nodes", f"{_p}edges", f"{_p}pr_{_i - 1}",
        )
    cte(
        f"{_p}pagerank",
        f"SELECT id, r * (SELECT count(*) / sum(r) FROM {_p}pr_6) AS pagerank FROM {_p}pr_6",
        f"{_p}pr_6",
    )


# Ids to look up: backwards, every third again, with unknown ones.
cte(
    "wanted",
    """
    SELECT doc_id, -doc_id * 10 AS pos FROM documents
    UNION ALL SELECT doc_id, -doc_id * 10 + 1 FROM documents WHERE doc_id % 3 = 0
    UNION ALL SELECT -7 - doc_id, -doc_id * 10 + 2 FROM documents""",
)


# Evaluation


cte(
    "qrels",
    """
    SELECT unnest([item_id * 2, item_id * 2 + 1]) AS query_id, doc_id
    FROM documents d JOIN benchmark b ON contains(d.text, b.text)""",
)
cte("judged", "SELECT query_id, count(*) AS relevant FROM qrels GROUP BY query_id", "qrels")
cte(
    "hits",
    """
    SELECT f.query_id, f.rank, q.doc_id IS NOT NULL AS hit
    FROM found f LEFT JOIN qrels q ON f.query_id = q.query_id AND f.doc_id = q.doc_id""",
    "found", "qrels",
)
cte(
    "m_p5",
    """
    SELECT j.query_id, coalesce(avg(CAST(hit AS INTEGER)), 0) AS precision
    FROM judged j LEFT JOIN hits h ON j.query_id = h.query_id AND rank <= 5 GROUP BY j.query_id""",
    "judged", "hits",
)
cte(
    "m_recall",
    """
    SELECT j.query_id, coalesce(count_if(hit), 0) / relevant AS recall
    FROM judged j LEFT JOIN hits h USING (query_id) GROUP BY j.query_id, relevant""",
    "judged", "hits",
)
cte(
    "m_f1",
    """
    SELECT query_id, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM (
      SELECT j.query_id, coalesce(count_if(hit) / nullif(count(hit), 0), 0) AS p, coalesce(count_if(hit), 0) / relevant AS r
      FROM judged j LEFT JOIN hits h ON j.query_id = h.query_id AND rank <= 30
      GROUP BY j.query_id, relevant)""",
    "judged", "hits",
)
cte(
    "m_ap",
    """
    SELECT j.query_id, coalesce(avg(p), 0) AS average_precision FROM judged j LEFT JOIN (
      SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) / rank AS p
      FROM hits WHERE hit AND rank <= 30) h ON j.query_id = h.query_id GROUP BY j.query_id""",
    "judged", "hits",
)


def extended(name: str, stemmed: str = "vocab") -> str:
    """The same CTE over words stemmed by the extended rules: copies of all it needs."""
    found: list[str] = []

    def reach(n: str) -> bool:
        below = [reach(m) for m in CTES[n][1]]
        changed = any(below) or re.fullmatch(rf"(title|body|anchor|query)_{stemmed}\d", n) is not None
        if changed and n not in found:
            found.append(n)
        return changed

    reach(name)
    renamed = re.compile(r"\b(" + "|".join(sorted(found, key=len, reverse=True)) + r")\b")
    for n in found:
        copy = f"{n}_x"
        if copy in CTES:
            continue
        if re.fullmatch(rf"\w+_{stemmed}\d", n):
            stems(copy, n.replace(stemmed, "kept"), extended=True)
        else:
            sql, needs = CTES[n]
            cte(copy, renamed.sub(r"\1_x", sql), *(f"{m}_x" if m in found else m for m in needs))
    return f"{name}_x"


def _scored(name: str, digits: int = 9) -> str:
    return sql_of(f"SELECT query_id, doc_id, rank, round(score, {digits}) AS score FROM {name}", name)


def _fused(name: str) -> str:
    rounded = f"round(score, {FUSED_DIGITS}) AS score"
    return sql_of(f"SELECT query_id, doc_id, {rounded} FROM {name}", name)


def _titled(name: str) -> str:
    return sql_of(
        f"""SELECT query_id, rank, CAST(doc_id AS VARCHAR) AS doc_id, title,
          round(score, {FUSED_DIGITS}) AS score
        FROM {name} JOIN docs ON id = doc_id""",
        name,
        "docs",
    )


def _matched(post: str) -> str:
    return sql_of(
        f"""
        SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
        FROM (SELECT query_id, doc_id, count(DISTINCT term) AS score FROM q_words JOIN {post} USING (term) GROUP BY ALL)""",
        "q_words",
        post,
    )


def _all_of(name: str) -> str:
    return sql_of(f"SELECT * FROM {name}", name)


_LINK = """'(?is)<a\\b[^>]*?\\shref\\s*=\\s*(?:"([^"]*)"|''([^'']*)'')[^>]*>(.*?)</a\\s*>'"""


def queries() -> dict[str, str]:
    plain = _PLAIN_TEXT.format
    return {
        "corpus_scan": sql_of(
            """SELECT id, title, text, coalesce(string_agg(dst || ':' || anchor, '|' ORDER BY dst, anchor), '') AS anchors
            FROM docs LEFT JOIN (SELECT src, dst, text AS anchor FROM links) ON src = id GROUP BY id, title, text""",
            "docs",
            "links",
        ),
        "field_projection": sql_of(
            """SELECT doc_id, text, 'title' AS field FROM title_field
            UNION ALL SELECT doc_id, text, 'body' FROM body_field
            UNION ALL SELECT dst, text, 'anchor' FROM links""",
            "title_field",
            "body_field",
            "links",
        ),
        "page_parse": f"""SELECT page_id,
            {plain("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title,
            {plain("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")} AS text,
            CAST(len(regexp_extract_all(html, {_LINK}, 1)) AS INTEGER) AS n_links FROM pages""",
        "page_link_parse": f"""SELECT page_id, pos, href, {plain("anchor")} AS anchor FROM (
            SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS pos, unnest(h) AS href, unnest(a) AS anchor
            FROM (SELECT page_id, list_transform(list_zip(regexp_extract_all(html, {_LINK}, 1), regexp_extract_all(html, {_LINK}, 2)),
                      lambda x: coalesce(x[1], '') || coalesce(x[2], '')) AS h, regexp_extract_all(html, {_LINK}, 3) AS a
                  FROM pages))""",
        "index_round_trip": sql_of(
            "SELECT term, doc_id, tf, df, doc_len FROM body_post JOIN body_len USING (doc_id)",
            "body_post",
            "body_len",
        ),
        "index_after_adding": sql_of(
            "SELECT term, doc_id, tf, df, doc_len FROM body_post JOIN body_len USING (doc_id)",
            "body_post",
            "body_len",
        ),
        "statistics_after_adding": _all_of("body_df"),
        "bm25_after_adding": _scored("bm25_mm"),
        "bm25_after_merge": _scored("bm25_mm"),
        "body_search_stored": _scored("body_cos"),
        "stats_from_other_build": sql_of(
            """SELECT query_id, doc_id, rank, round(score, 9) AS score, 'bm25' AS model FROM other_bm25_mm
            UNION ALL SELECT query_id, doc_id, rank, round(score, 9), 'cosine' FROM other_cosine_mm""",
            "other_bm25_mm",
            "other_cosine_mm",
        ),
        "tokens_index_profile": _all_of("body_tok3"),
        "tokens_query_profile": _all_of("body_tok2"),
        "stopword_filter_pre": _all_of("body_kept3"),
        "stem_vocabulary": sql_of("SELECT word, stem FROM whole_vocab", "whole_vocab"),
        "stem_vocabulary_extended": sql_of("SELECT word, stem FROM extended_vocab", "extended_vocab"),
        "stopword_filter_post": sql_of(
            f"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS pos, term
            FROM body_stem3 WHERE term NOT IN {ALL}""",
            "body_stem3",
        ),
        "bigrams": sql_of("SELECT DISTINCT doc_id, term AS gram FROM body_gram3", "body_gram3"),
        "bigram_index_title": _all_of("title_grams_post"),
        "title_index_min_df": sql_of(
            "SELECT term, doc_id, tf, df, doc_len FROM title_post JOIN title_len USING (doc_id) WHERE df > 20",
            "title_post",
            "title_len",
        ),
        "bigram_index_body": _all_of("body_grams_post"),
        "title_word_count": sql_of(
            "SELECT doc_id, CAST(raw_words AS INTEGER) AS raw_words FROM raw_title", "raw_title"
        ),
        "term_frequency": _all_of("body_tf"),
        "term_frequency_anchor": _all_of("anchor_tf"),
        "query_term_frequency": _all_of("q_counted"),
        "doc_length": _all_of("body_len"),
        "posting_lists": sql_of(
            """SELECT term, doc_id // 100000 AS part, string_agg(doc_id || ':' || tf, ' ' ORDER BY doc_id) AS postings
            FROM body_post GROUP BY ALL""",
            "body_post",
        ),
        "posting_lookup": sql_of(
            "SELECT query_id, term, doc_id, tf FROM q_terms JOIN body_post USING (term)", "q_terms", "body_post"
        ),
        "document_frequency": sql_of("SELECT term, df FROM body_df", "body_df"),
        "collection_frequency": _all_of("body_df"),
        "min_df_filter": sql_of("SELECT term, doc_id, tf FROM body_post", "body_post"),
        "corpus_stats": sql_of(
            " UNION ALL ".join(
                f"SELECT count(*) AS n_docs, round(avg(doc_len), 9) AS avgdl, '{f}' AS field FROM {f}_len"
                for f in ("title", "body", "anchor")
            ),
            "title_len",
            "body_len",
            "anchor_len",
        ),
        "title_map": sql_of("SELECT id AS doc_id, title FROM docs", "docs"),
        "doc_norms": sql_of("SELECT doc_id, round(norm2, 9) AS norm2 FROM body_norm", "body_norm"),
        "tf_idf": sql_of(
            f"SELECT term, doc_id, round(tf * {IDF}, 9) AS weight FROM body_post", "body_post"
        ),
        "cosine_search": _scored("cosine_mm"),
        "cosine_unnormalized": _scored("dot_body", 11),
        "bm25_search": _scored("bm25_mm"),
        "bm25_blocks": _scored("bm25_mm"),
        "bm25_fixed_avgdl": _scored("bm25_fixed_mm"),
        "bm25_extended_stems": _scored(extended("bm25_mm")),
        "bm25_all_terms": _scored("bm25_all_mm"),
        "title_coverage": _scored("title_cov_mm"),
        "title_bigram_jaccard": _scored("title_jac_mm"),
        "anchor_count": _scored("anchor_cnt_mm"),
        "body_bigram": sql_of(
            "SELECT query_id, doc_id, rank, round(score, 9) AS score, matched FROM body_2_mm", "body_2_mm"
        ),
        "body_search_contract": _scored("body_cos"),
        "title_search_contract": _matched("title_words_post"),
        "anchor_search_contract": _matched("anchor_words_post"),
        "minmax_zero": _scored("view_scores_mm"),
        "minmax_keep": _scored("view_scores_keep"),
        "fuse_one_word": _fused("f_one"),
        "fuse_base": _fused("f_base"),
        "fuse_multi_word": _fused("f_multi"),
        "fuse_notebook": _titled("f_notebook"),
        "search": _titled("found"),
        "search_extended_stems": _titled(extended("found")),
        "link_edges": _all_of("edges"),
        "link_vertices": _all_of("nodes"),
        "pagerank": sql_of("SELECT id, round(pagerank, 9) AS pagerank FROM pagerank", "pagerank"),
        "pagerank_sinks": sql_of("SELECT id, round(pagerank, 9) AS pagerank FROM sink_pagerank", "sink_pagerank"),
        "page_graph": f"""WITH l AS (
              SELECT page_id, regexp_extract(url, '^([^:]+://[^/?#]*)', 1) AS site,
                     regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*/)', 1) AS folder,
                     unnest(list_transform(list_zip(regexp_extract_all(html, {_LINK}, 1), regexp_extract_all(html, {_LINK}, 2)),
                       lambda x: regexp_replace(trim(coalesce(x[1], '') || coalesce(x[2], '')), '#.*$', ''))) AS href FROM pages),
            e AS (SELECT DISTINCT page_id, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
                WHEN starts_with(href, '/') THEN site || href ELSE site || folder || href END AS url FROM l)
            SELECT e.page_id, e.url, p.target FROM e LEFT JOIN (
              SELECT regexp_replace(url, '#.*$', '') AS url, min(page_id) AS target FROM pages GROUP BY 1) p ON p.url = e.url
            WHERE regexp_matches(e.url, '^https?://')""",
        "pagerank_ranked": sql_of(
            f"""SELECT row_number() OVER (ORDER BY {significant('pagerank')} DESC, id) AS rank, id,
              round(pagerank, 9) AS pagerank FROM pagerank""",
            "pagerank",
        ),
        "pagerank_lookup": sql_of(
            """SELECT pos, doc_id, round(coalesce(pagerank, 0), 9) AS pagerank
            FROM wanted LEFT JOIN pagerank ON id = doc_id""",
            "pagerank",
            "wanted",
        ),
        "pageview_lookup": f"""WITH wanted AS ({CTES["wanted"][0]})
            SELECT pos, doc_id, coalesce(views, 0) AS views FROM wanted LEFT JOIN (
            SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS doc_id, count(*) AS views FROM events
            WHERE event_type = 'view' AND date_trunc('month', ts) = DATE '{VIEW_MONTH}' GROUP BY 1) USING (doc_id)""",
        "pageviews_by_title": sql_of(
            f"""SELECT f.doc_id, count(*) AS views
            FROM events JOIN docs d ON d.id = CAST(json_extract_string(props, '$.k') AS BIGINT)
            JOIN (SELECT replace(title, '_', ' ') AS name, min(id) AS doc_id FROM docs GROUP BY 1) f
              ON f.name = replace(d.title, '_', ' ')
            WHERE event_type = 'view' AND date_trunc('month', ts) = DATE '{VIEW_MONTH}' GROUP BY 1""",
            "docs",
        ),
        "relevance": _all_of("qrels"),
        "precision_at_5": sql_of("SELECT query_id, round(precision, 9) AS precision FROM m_p5", "m_p5"),
        "recall": sql_of("SELECT query_id, round(recall, 9) AS recall FROM m_recall", "m_recall"),
        "f1_at_30": sql_of("SELECT query_id, round(f1, 9) AS f1 FROM m_f1", "m_f1"),
        "average_precision": sql_of(
            "SELECT query_id, round(average_precision, 9) AS average_precision FROM m_ap", "m_ap"
        ),
        "benchmark_mean": sql_of(
            """SELECT count(*) AS n_queries, round(coalesce(avg(precision), 0), 9) AS precision_at_5,
              round(coalesce(avg(recall), 0), 9) AS recall, round(coalesce(avg(f1), 0), 9) AS f1_at_30,
              round(coalesce(avg(average_precision), 0), 9) AS map_at_30
            FROM m_p5 JOIN m_recall USING (query_id) JOIN m_f1 USING (query_id) JOIN m_ap USING (query_id)""",
            "m_p5",
            "m_recall",
            "m_f1",
            "m_ap",
        ),
    }
