"""Benchmark decontamination."""

import pytest

from broadsheet.llm import decontaminate as D

ITEM = "a train leaves at 9 with 120 people and after 9 minutes then asks Anna how many people of the 120 remain"


def held(doc, item=ITEM):
    return D.Items([1], [item.encode()]).matches(doc.encode())


@pytest.mark.parametrize(
    "doc,found,exact",
    [
        (ITEM, True, True),
        ("before it. " + ITEM.upper() + " and after", True, False),
        ("x " + ITEM.replace("120", "77").replace("9", "4").replace("Anna", "Berta") + " y", True, False),
        ("nothing of the kind is here and nothing will be found in this text at all I hope", False, None),
        (" ".join(ITEM.split()[:5]), False, None),
        ("", False, None),
    ],
)
def test_templates(doc, found, exact):
    got = held(doc)
    assert bool(got) == found
    if found and exact:
        assert got[0][-1]


def test_slots_have_to_agree():
    item = "take 5 of them then give 5 to her and keep 5 for you so that 5 of 5 are gone by then"
    same, mixed = item.replace("5", "8"), item
    for i in (1, 2, 3, 4):
        mixed = mixed.replace("5", str(i), 1)
    (good,) = held(same, item)
    assert good[2] == good[1]
    assert not held(mixed, item) or held(mixed, item)[0][2] < good[2]


@pytest.mark.parametrize("word,kind", [("12,5", 0), ("$30", 0), ("Anna", 1), ("km", 2), ("5kg", 3), ("anna", -1), ("É", -1)])
def test_classes(word, kind):
    assert D.classify(word.encode(), False)[1] == kind


def test_frames_and_blocks(spark, monkeypatch):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(12)] + [(90, None), (91, ""), (None, "x " * 20)]
    items += [(92, "short item here")]
    rows = [(i, "begin " + items[i][1] + " end", "x") for i in range(12)] + [(50, "clean " * 30, "x"), (51, None, "x"), (52, "", "x")]
    rows += [(3, "again " + items[3][1], "x"), (None, items[4][1], "x"), (53, "a short item here b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = sorted([(i, i) for i in range(12)] + [(3, 3), (None, 4), (53, 92)], key=str)
    monkeypatch.setattr(D, "BLOCK_WORDS", 100)
    found = D.find_contaminated(docs, benchmark)
    assert sorted(((r.doc_id, r.item_id) for r in found.collect()), key=str) == want
    kept = D.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [50, 51, 52]
    assert D.find_contaminated(docs, benchmark.limit(0)).count() == 0
    assert D.drop_contaminated(docs, benchmark.limit(0)).count() == len(rows)


@pytest.mark.parametrize(
    "item,doc",
    [
        # Names mostly at the start of sentences.
        (
            "Tom has 5 apples. Tom gives 2 apples to Ann. Ann eats 1 apple at once. Tom buys 6 pears and how many are left",
            "Bob has 7 apples. Bob gives 3 apples to Eve. Eve eats 2 apple at once. Bob buys 9 pears and how many are left",
        ),
        # A slot of another number of words, and a word put in.
        ("in the old town a girl called Anna sells sweet red plums to all", "in the old town a girl called Anna Maria sells sweet red plums to all"),
        ("every day the mule walks about 5 km up a steep hill without rest", "every day the mule walks about 5km up a steep hill without rest"),
        ("red green blue black white grey pink brown gold teal", "red green blue black white very grey pink brown gold teal"),
        (" ".join(f"w{i}x" for i in range(26)), " ".join(["more" if i == 13 else f"w{i - (i > 13)}x" for i in range(27)])),
    ],
)
def test_changed_copies(item, doc):
    assert held("so it is told " + doc + " and then it ends", item)


def test_other_texts_are_not_held():
    item = "Tom has 5 apples. Tom gives 2 apples to Ann. Ann eats 1 apple at once. How many are left"
    assert not held("Bob has 7 coins. Eve takes 2 coins from Max. Max spends 1 coin on tea. How many are there", item)
    # Names that do not stand for one another throughout.
    mixed = "Bob has 5 apples. Max gives 2 apples to Eve. Kim eats 1 apple at once. How many are left"
    got = held(mixed, item)
    assert not got or got[0][2] < got[0][1]


@pytest.mark.parametrize(
    "item",
    ["What is 3 + 4?", "Who wrote Hamlet and Macbeth?", "Anna lives in Rome", "1 1 2 3 5 8 13 21 34 55 89 144", "Tom 3 km Ann 5 km Max 7 km Eve 9 km", "Is 7 ?"],
)
def test_verbatim_copies_of_slots(item):
    for before in ("so it reads: ", "and then Bob ", "1 ", "End. "):
        (found,) = held(before + item + " 0 and more", item)
        assert found[2] == found[1] and found[-1]
    assert not held("so it reads: " + " ".join(reversed(item.split())) + " and more", item)


def test_verbatim_copies_survive_no_pipeline_stage(spark):
    docs = spark.createDataFrame([(1, "asked: Who wrote Hamlet and Macbeth? told"), (2, "something else")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, "Who wrote Hamlet and Macbeth?")], "item_id long, text string")
    assert [r.doc_id for r in D.drop_contaminated(docs, benchmark).collect()] == [2]
    assert [(r.doc_id, r.item_id, r.exact) for r in D.find_contaminated(docs, benchmark).collect()] == [(1, 7, True)]
