"""What the driver holds and how many steps it plans, where that grew beyond need."""

from __future__ import annotations

import random
import tracemalloc

import pytest

from tablewright.llm import language_id, near_dedup


@pytest.mark.parametrize(("in_part", "most"), [(near_dedup.LINKS_IN_PART, 2), (40, 99)])
def test_components_of_few_links_take_no_star_steps(spark, monkeypatch, in_part, most):
    """Links that fit one task are done when it has contracted them; the others go on to the star steps. Both give the same."""
    rng, steps = random.Random(5), []
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)]
    plain = near_dedup.checkpointed
    monkeypatch.setattr(near_dedup, "LINKS_IN_PART", in_part)
    monkeypatch.setattr(near_dedup, "checkpointed", lambda df: steps.append(1) or plain(df))
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    least = {x: x for link in links for x in link}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {x: y for x, y in least.items() if x != y}
    assert len(steps) <= most


def test_training_does_not_hold_the_words_of_all_texts():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(1000)]
    texts = [" ".join(rng.choices(words, k=10_000)) for _ in range(40)]
    tracemalloc.start()
    try:
        model = language_id.train(texts, [["x", "y"][k % 2] for k in range(40)])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.languages == ["x", "y"]
    assert peak < 25e6  # the words of all texts alone take 26 MB
