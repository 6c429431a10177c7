"""Verbatim copies of short and slot-heavy benchmark items are found."""

from rasterloom.llm import decontam

ITEMS = [
    (1, "Name the capital of France"),
    (2, "Compute 12 + 7 * 3 - 5 / 2 + 9 * 4 - 1"),
    (3, "List Anna, Berta, Carla, Dora, Emma, Frida, Greta and Hanna"),
    (4, "Water boils at which temperature under normal pressure"),
    (5, "a longer item in plain words that has many windows and needs no other way to be found"),
    (6, " ?! "),
]


def test_verbatim_short_items_are_found(spark, documents):
    rows = [(i, f"some text before, {t} and more after it") for i, t in ITEMS[:5]] + [(9, "name the capital of Spain, compute 12 + 7"), (10, ""), (11, None)]
    found = decontam.contaminated(documents(rows), spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i) for i in range(1, 6)} and len(found) == 5
