import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexigraph.llm import chat as C


def brute(rows):
    convs = defaultdict(list)
    for r in rows:
        convs[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    found = {}
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        found[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return found


def result(turns):
    return {r.conv_id: tuple(r)[1:5] for r in C.read_back(C.write_examples(turns)).collect()}


ODD = ["<|turn|>", "<|end|>\n", "\\", "<\\|", "\n", "\\n", "|", "<", "", "user", "assistant", "ü☃𝒳", "\x00\x01"]
PIECES = st.lists(st.sampled_from(ODD), max_size=6).map("".join)


@settings(deadline=None, max_examples=4)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), PIECES), st.one_of(st.none(), PIECES)), max_size=40))
def test_any_roles_and_texts(spark, rows):
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    assert result(df) == brute(df.collect())


def test_whole_table(spark, folder):
    df = spark.read.parquet(f"{folder}/conversations.parquet")
    assert result(df) == brute(df.collect())


def test_examples(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "so"), (1, 3, "assistant", "a<|end|>"), (1, 4, "user", "end"), (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").withColumn("heads", F.lit(1))
    got = {(r.conv_id, r.example): (r.context, r.target, r.tail) for r in C.expand(df).collect()}
    first = "<|turn|>user\nhi<|end|>\n<|turn|>assistant\n"
    second = first + "yes<|end|>\n<|turn|>user\nso<|end|>\n<|turn|>assistant\n"
    assert got == {
        (1, 2): (first, "yes", C.END),
        (1, 4): (second, "a<\\|end|>", C.END),
        (1, 5): (second + "a<\\|end|><|end|>\n<|turn|>user\nend<|end|>\n", None, ""),
        (None, 1): ("<|turn|>user\nx<|end|>\n", None, ""),
    }
    assert C.expand(df.filter("false")).collect() == [] == C.read_back(C.expand(df.filter("false"))).collect()
