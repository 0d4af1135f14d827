import corpus_pipeline as P
from lexigraph.llm import exact_dedup, mixing, queries
from lexigraph.llm.common import space
from pyspark.sql import functions as F
from test_jaccard import brute


def test_stages(spark, documents, folder):
    work, docs = space(spark, "test"), documents
    kept = {}
    for name, stage in P.STAGES:
        before, docs = docs, work.write(stage(spark, docs, folder), name)
        kept[name] = docs
        if name != P.STAGES[-1][0]:
            assert docs.columns == documents.columns
        if name == "language":
            assert docs.count() == before.filter(F.col("text").rlike(r"\p{L}")).count()
        if name == "exact_dedup":
            want = exact_dedup.exact_dedup(before).filter("kept")
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in want.collect()}
        if name == "near_dedup":
            want = {d for d, c in brute([(r.doc_id, r.text) for r in before.collect()]) if d == c}
            assert {r.doc_id for r in docs.collect()} == want
        if name == "mixing":
            want = {r.doc_id: r.copies for r in mixing.mixing_plan(before).collect() if r.copies}
            assert {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()} == want
    rows = kept["sentencepiece"].collect()
    assert len(rows) == kept["mixing"].count() and all(r.n_pieces == len(r.piece_ids) for r in rows)
    assert sorted(r.doc_id for r in P.run(spark, folder).collect()) == sorted(r.doc_id for r in rows)


def test_odd_rows(spark, docs, empty, folder):
    work = space(spark, "test")
    for rows in (docs, empty):
        now = rows
        for name, stage in P.STAGES:
            now = work.write(stage(spark, now, folder), name)
            if name != P.STAGES[-1][0]:
                assert now.columns == docs.columns
        assert bool(now.count()) == (rows is docs)


def test_registered_for_every_operator():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))


FOREIGN = [
    "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    "qzx vkjw pqff zzkq wxvb jjqk hgfd zxcv bnmq wrtp kjhg fdsq mnbv cxzl kjhp oiuq wert zxqp vvkj",
    "これは日本語の文章です。学習されていない言語なので、パイプラインはこの文章を取り除くはずです。長さも十分にあります。",
]
LEARNED = [
    "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood.",
    "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geist der Brüderlichkeit begegnen.",
    "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité.",
    "Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros.",
]


def test_language_stage_rejects_unlearned_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    told = [(-1 - i, t, None, "told", len(t)) for i, t in enumerate(FOREIGN + LEARNED)]
    kept = P.language(spark, docs.unionByName(spark.createDataFrame(told, docs.schema)), "").select("doc_id", "text")
    left = {r.doc_id for r in kept.filter("doc_id < 0").collect()}
    assert left == {-1 - len(FOREIGN) - i for i in range(len(LEARNED))}
    clean = docs.filter(F.col("text").rlike(r"\p{L}")).count()
    assert kept.filter("doc_id >= 0").count() >= 0.99 * clean
