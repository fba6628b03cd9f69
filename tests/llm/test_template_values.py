"""Decontamination: values that disagree, collide or are all that a text has."""

from murmur.llm import template

ITEM = "Yesterday a farmer named Anna sold 12 apples and then Anna sold 30 pears to her old friend Bob for 7 dollars in all"


def judged(spark, rows, items):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r.doc_id: r for r in template.contaminated(docs, bench).collect()}


def test_one_value_that_disagrees(spark):
    got = judged(spark, [ITEM.replace("then Anna", "then Clara")], [ITEM])
    assert got[0].contaminated and got[0].share >= 22 / 24


def test_values_that_collide(spark):
    one = ITEM.replace("12", "8").replace("30", "8")
    two = ITEM.replace("12", "30")  # equal in the item, different in the document
    got = judged(spark, [one, ITEM], [ITEM])
    assert got[0].contaminated and not got[0].verbatim and got[1].verbatim
    assert judged(spark, [ITEM.replace("12", "5")], [two])[0].contaminated


def test_items_of_little_but_values(spark):
    items = ["Calculate 15% of 240", "John Smith met Mary Jones in Paris", ITEM]
    got = judged(spark, ["so: calculate 15% of 240.", "JOHN SMITH MET MARY JONES IN PARIS", "x " * 50 + ITEM.upper(), ITEM.lower(), "calculate 16% of 240"], items)
    assert [list(got[i]["items"]) for i in range(5)] == [[0], [1], [2], [2], []]
    assert got[0].verbatim and got[1].verbatim and got[2].verbatim and got[2].share == 1.0


def test_names_of_several_words(spark):
    item = "In the old town John Smith met Mary Ann Jones and they both walked to the river with 3 dogs"
    got = judged(spark, [item.replace("John Smith", "Tom Brown Junior").replace("Mary Ann Jones", "Eve").replace("3", "9"), item], [item])
    assert got[0].contaminated and not got[0].verbatim and got[0].share == 1.0
    assert got[1].verbatim
