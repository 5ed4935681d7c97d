"""Near-dedup runs dozens of short queries; what they leave must not add up until the driver's garbage is collected."""

from ledgerloom.llm import components


def test_rounds_of_components_let_go(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(components, "let_go", calls.append, raising=False)
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    found = components.connected_components(links).collect()
    assert {r["node"] for r in found} == set(range(41)) and {r["component"] for r in found} == {0}
    assert calls
