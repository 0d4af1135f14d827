import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from lexigraph.llm.memo import CountMemo, SpanMemo, held

TEXTS = st.lists(st.lists(st.text("ab☃", max_size=3), max_size=6), max_size=5)


@given(st.lists(TEXTS, max_size=4))
def test_spans_however_little_is_remembered(batches):
    memo = SpanMemo(lambda words: [[ord(c) for c in w] for w in words], most=2, values=5)
    for texts in batches:
        assert [x.tolist() for x in memo.batch(texts)] == [[ord(c) for w in words for c in w] for words in texts]


@given(TEXTS)
def test_totals_however_little_is_remembered(texts):
    memo = CountMemo(lambda w: [len(w), 1], 2, most=1)
    for words in texts:
        assert np.array_equal(memo.total(words), [sum(map(len, words)), len(words)])


def test_one_model_at_a_time():
    made = []
    for key in ("a", "a", "b", "a"):
        held((key,), lambda: made.append(key) or key)
    assert made == ["a", "b", "a"]


def test_a_model_is_dropped_before_another_is_made():
    """The memory of an earlier stage's model stayed with the worker."""
    from lexigraph.llm import memo

    class Model:
        alive = 0

        def __init__(self):
            Model.alive += 1
            # Only the collector frees a cycle.
            self.own = self

        def __del__(self):
            Model.alive -= 1

    first = memo.held(("first",), Model)
    assert memo.held(("first",), Model) is first and Model.alive == 1
    del first
    memo.held(("second",), lambda: Model.alive == 0 and Model())
    assert Model.alive == 1
    memo.forget()
    assert Model.alive == 0
