"""Long runs of letters give features from all of their letters."""

from pathloom.llm import toxicity


def test_long_runs_of_letters_are_read_whole():
    tail = toxicity.word_features("b" * 40 + "vileness")
    found = set(toxicity.Features().of("a" * 64 + "b" * 40 + "vileness").tolist())
    assert found >= toxicity.word_features("a" * 64 + "b" * 40 + "vileness") and len(found & tail) > 5
    small = toxicity.Features(memo=1000)
    for i in range(100):
        small.of("w" * (i + 1))
    assert small.held <= 1000
