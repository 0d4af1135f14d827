"""Tokens, grams, counts and stems against plain Python."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexigraph.functions import stopwords, tokens
from lexigraph.functions.stem import stem, stem_array
from lexigraph.operators import analyze
from lexigraph.operators.analyze import INDEX, QUERY, Profile, counts, forward_rows, merge_pieces
from lexigraph.sources.pages import parse_pages

PORTER = """
caresses caress · ponies poni · ties ti · cats cat · feed feed · agreed agre · plastered plaster
· bled bled · motoring motor · sing sing · conflated conflat · troubled troubl · sized size
· hopping hop · tanned tan · falling fall · hissing hiss · fizzed fizz · failing fail
· filing file · happy happi · sky sky · relational relat · conditional condit
· rational ration · valenci valenc · digitizer digit · conformabli conform
· radicalli radic · differentli differ · vileli vile · analogousli analog
· vietnamization vietnam · predication predic · operator oper · feudalism feudal
· decisiveness decis · hopefulness hope · callousness callous · formaliti formal
· sensitiviti sensit · sensibiliti sensibl · triplicate triplic · formative form
· formalize formal · electriciti electr · electrical electr · hopeful hope · goodness good
· revival reviv · allowance allow · inference infer · airliner airlin
· gyroscopic gyroscop · adjustable adjust · defensible defens · irritant irrit
· replacement replac · adjustment adjust · dependent depend · adoption adopt
· homologou homolog · communism commun · activate activ · angulariti angular
· homologous homolog · effective effect · bowdlerize bowdler · probate probat · rate rate
· cease ceas · controll control · roll roll · category categori · references refer
· became becam · links link · having have · generalizations gener · oscillators oscil
"""

TEXTS = st.lists(
    st.text(
        alphabet=st.sampled_from(list("abe'-#@_ .\n19éßñüчж漢|")), min_size=0, max_size=60
    ),
    min_size=1,
    max_size=8,
)
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")


def test_porter_word_list(spark):
    pairs = [tuple(p.split()) for p in PORTER.replace("\n", " ").split("·")]
    df = spark.createDataFrame(pairs, "word STRING, stem STRING")
    got = df.withColumn("got", F.expr(f"{stem_array('array(word)')}[0]"))
    assert len(pairs) == 80
    assert [r for r in got.collect() if r["stem"] != r["got"]] == []


EXTENDED = """
dies die · ties tie · flies fli · skies sky · sky sky · dying die · spied spi · died die · news news
· innings inning · enjoy enjoy · happy happi · by by · proceed proceed · conditionally condit
· nationally nation · geology geolog · hopefully hope · possibly possibl · eve eve · caresses caress
· relational relat · generously gener · controlling control
"""


def test_extended_rules(spark):
    pairs = [tuple(p.split()) for p in EXTENDED.replace("\n", " ").split("·")]
    df = spark.createDataFrame(pairs, "word STRING, stem STRING")
    got = df.withColumn("got", F.expr(f"{stem_array('array(word)', extended=True)}[0]"))
    assert [r for r in got.collect() if r["stem"] != r["got"]] == []


def test_short_words_are_not_stemmed(spark):
    words = spark.createDataFrame([(["as", "is", "by", "ées", "cats"],)], "w ARRAY<STRING>")
    assert words.select(F.expr(stem_array("w"))).first()[0] == ["as", "is", "by", "ée", "cat"]


def test_stop_words_are_sparks_default_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(stopwords.ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")


def test_stop_words_with_apostrophes_are_dropped(spark):
    df = frame(spark, ["don't store the heat"])
    got = df.select(F.expr(tokens.without(tokens.tokens("text")))).first()[0]
    assert got == ["store", "heat"]


@FEW
@given(TEXTS)
def test_tokens_match_python(spark, texts):
    for n in (tokens.INDEX_MIN_CHARS, tokens.QUERY_MIN_CHARS):
        word = re.compile(rf"[#@\w](?:['\-]?\w){{{n - 1},24}}")
        df = frame(spark, texts).select("doc_id", F.expr(tokens.tokens("text", n)).alias("t"))
        got = {r["doc_id"]: r["t"] for r in df.collect()}
        assert got == {i: word.findall(t.lower()) for i, t in enumerate(texts)}


@FEW
@given(TEXTS)
def test_raw_word_count_matches_python(spark, texts):
    df = frame(spark, texts).select("doc_id", F.expr(tokens.raw_word_count("text")).alias("n"))
    got = {r["doc_id"]: r["n"] for r in df.collect()}
    assert got == {i: len(re.sub(r"[^\w]", " ", t).split(" ")) for i, t in enumerate(texts)}


@FEW
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=12), min_size=1, max_size=6))
def test_grams_and_counts_match_python(spark, arrays):
    df = spark.createDataFrame(list(enumerate(arrays)), "doc_id BIGINT, words ARRAY<STRING>")
    df = counts(df.withColumn("grams", F.expr(tokens.grams("words"))), "words", "grams")
    for r in df.collect():
        words = arrays[r["doc_id"]]
        assert {c["term"]: c["tf"] for c in r["words"]} == Counter(words)
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        assert {c["term"]: c["tf"] for c in r["grams"]} == Counter(pairs)


def test_pieces_of_one_document_add_up(spark):
    pieces = spark.createDataFrame([(1, ["a", "b"]), (1, ["a"]), (2, [])], "doc_id BIGINT, terms ARRAY<STRING>")
    rows = counts(
        pieces.withColumn("doc_len", F.size("terms")).withColumn("words", F.col("terms")), "terms", "words"
    )
    ids = spark.createDataFrame([(1,), (2,), (3,)], "doc_id BIGINT")
    got = {(r["doc_id"], r["kind"], r["term"]): r["tf"] for r in merge_pieces(rows, ids).collect()}
    assert got[(1, "terms", "a")] == 2 and got[(1, "words", "b")] == 1
    assert [got[(i, "doc_len", "")] for i in (1, 2, 3)] == [3, 0, 0]


def test_links_in_any_markup(spark):
    html = (
        "<TITLE lang='en'>A &amp; B</TITLE><article class=\"x\"><A class='k' HREF='/one'>first</A> and "
        '<a\nid="2" href = "/two" rel=x>sec<b>ond</b></a > <abbr href="/no">no</abbr></Article>'
    )
    parsed = parse_pages(spark.createDataFrame([(1, "u", html)], "page_id BIGINT, url STRING, html STRING"))
    row = parsed.first()
    assert (row["title"], row["text"]) == ("A & B", "first and sec ond no")
    assert [(a["href"], a["text"]) for a in row["anchors"]] == [("/one", "first"), ("/two", "sec ond")]


WORDS = (PORTER + EXTENDED).replace("·", " ").split() + "sky's ées añadied x-rays yying ed ing eed sion ll ions 漢字s agreed-ed".split()


def test_one_word_is_stemmed_as_in_an_array(spark):
    df = spark.createDataFrame([(WORDS,)], "w ARRAY<STRING>")
    for extended in (False, True):
        got = df.select(F.expr(stem_array("w", True, extended))).first()[0]
        assert got == [stem(w, extended) for w in WORDS]


def test_forward_rows_match_the_expressions(spark, monkeypatch):
    """Each distinct word of a slice is stemmed once, where arrays were stemmed word by word."""
    met = []
    monkeypatch.setattr(analyze, "stem", lambda w, x: met.append(w) or stem(w, x))
    analyze._Words(__import__("pyarrow").array([["cats", "cats"], None, ["cats", "dogs"]]), INDEX)
    assert sorted(met) == ["cats", "dogs"]
    texts = ["Cats and dogs, cats and relational dogs became links", None, "", "references", "it's on", "a is by us ties a is", "cats " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").withColumn("more", F.col("doc_id") * 2)
    for profile in (INDEX, Profile(extended=True), Profile(min_chars=2, stop_words=(), index_stop_words=())):
        got = {r["doc_id"]: r for r in forward_rows(docs, profile, QUERY).collect()}
        plain, stems = profile.plain_words("text"), profile.words("text")
        expected = docs.select(
            "doc_id",
            F.expr(f"size({stems})").alias("doc_len"),
            F.expr(profile.indexed(stems)).alias("terms"),
            F.expr(tokens.grams(stems)).alias("grams"),
            F.expr(profile.indexed(plain)).alias("words"),
            F.expr(f"array_distinct({tokens.grams(QUERY.words('text'))})").alias("query_grams"),
        )
        for r in expected.collect():
            row = got[r["doc_id"]]
            assert (row["more"], row["doc_len"]) == (2 * r["doc_id"], r["doc_len"])
            for kind in ("terms", "grams", "words", "query_grams"):
                assert {c["term"]: c["tf"] for c in row[kind]} == Counter(r[kind] or [])
            assert row["n_title_grams"] == (None if r["query_grams"] is None else len(r["query_grams"]))


def test_slices_are_cut_by_words(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(analyze, "WORDS_PER_SLICE", 5)
    rows = pa.RecordBatch.from_arrays([pa.array([["a"] * n if n else None for n in (3, 2, 9, 0, 1)])], ["w"])
    assert [[len(x or []) for x in p.column("w").to_pylist()] for p in analyze._slices(rows, "w")] == [[3, 2], [9], [0, 1]]
