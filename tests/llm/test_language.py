from pyspark.sql import functions as F

from lexigraph.llm import language as L


def substrings(text):
    return {text[a:b] for a in range(len(text)) for b in range(a + 1, len(text) + 1)}


def test_automaton_accepts_exactly_the_substrings():
    for text in ["abracadabra", "aaaa", " the of and then ", "abcabcabx", ""]:
        step, own = L.suffix_automaton(text), substrings(text)
        for probe in own | {p + "z" for p in own} | {"ba", "ca ", "aab"}:
            state = 0
            for ch in probe:
                state = step[state].get(ch, -1)
                if state < 0:
                    break
            assert (state >= 0) == (probe in own)


def brute_phrases(sample, text):
    known, at, count = substrings(sample), 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in known:
            size += 1
        at, count = at + size, count + 1
    return count


def test_phrases_are_longest_matches():
    sample = " the of and then there he is "
    for text in [" there ", " xhen ", " zzz ", " andthe of ", " h "]:
        assert L.phrases(L.suffix_automaton(sample), text) == brute_phrases(sample, text)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    samples = L.fit(docs, ~L.held_out())
    assert [lang for lang, _ in samples] == ["de", "en", "es", "fr"]
    assert all(len(text) <= L.LANGUAGE_CHARS + 1 for _, text in samples)
    found = L.identify(docs, samples).filter(L.held_out())
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.max("rate").alias("r")).first()
    assert right.a > 0.99 and right.r < 0.5


def test_odd_rows(docs, empty):
    samples = L.fit(docs)
    assert [lang for lang, _ in samples] == ["de", "en"]
    rows = L.identify(docs, samples).collect()
    assert len(rows) == docs.count() and rows[0].size == "x"
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1 and 0 < r.rate <= 1
    by_text = {r.text: r.lang_pred for r in rows}
    assert by_text["One two three four five six seven"] == "en"
    assert L.identify(empty, samples).collect() == [] == L.identify(empty, L.fit(empty)).collect()
    assert {r.lang_pred for r in L.identify(docs, []).collect()} == {"und"}


def test_counts_are_those_of_the_automata(monkeypatch):
    samples = [("x", " the of and then there he is "), ("y", " à là demain, abracadabra "), ("z", " ")]
    texts = [" there is ", " demain ", "", " zzz abra the ☃ ", " the" * 40 + " ", " "]
    for block in (7, 1000):
        monkeypatch.setattr(L, "BLOCK", block)
        for dense in (L.DENSE, 0):
            monkeypatch.setattr(L, "DENSE", dense)
            parser = L.Parser(samples)
            assert (parser.table is None) == (dense == 0)
            want = [[sum(brute_phrases(s, t[k : k + block]) for k in range(0, len(t), block)) for _, s in samples] for t in texts]
            assert parser.counts(texts).tolist() == want


def test_passages_are_words_of_the_text(spark):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)]
    rows = [(i, " ".join(words[i * 10 : i * 10 + 300]), "en") for i in range(200)] + [(900 + i, "kurz", "de") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    samples = dict(L.fit(docs))
    assert samples["de"] == " kurz " and set(samples["en"].split()) <= set(words)
    # Passages come from all over the texts.
    assert len(set(samples["en"].split())) > 1000 and len(samples["en"]) <= L.LANGUAGE_CHARS


def test_no_limit_without_further_texts(spark, docs):
    assert L.foreign_rate(docs, []) == float("inf")
    one = spark.createDataFrame([(1, "one text only that is long enough for a limit", "en")], "doc_id BIGINT, text STRING, lang STRING")
    assert L.foreign_rate(one, L.fit(one)) == float("inf")
