import functools
import re

from pyspark.sql import functions as F

from riskview.llm import decontamination
from riskview.llm.decontamination import UNITS, contaminated, decontaminate
from tests.llm.helpers import AWKWARD, documents, given, words

MARKS = set(".,;:!?\"'()[]{}«»„“”‘’…*#%&$|<>")


@functools.lru_cache(None)
def template(text):
    """Template words and their values, word by word."""
    raw = words(text)
    out = []
    for i, w in enumerate(raw):
        plain = "".join(c for c in w if c not in MARKS)
        if not plain:
            continue
        inside = i > 0 and raw[i - 1][-1] not in ".!?:" and re.search(re.escape(raw[i - 1]) + r"[ \t]" + re.escape(w), text)
        if w[0].isupper() and inside:
            kind = "<name>"
        elif re.search("[0-9]", plain):
            kind = "<number>"
        elif plain.lower() in UNITS and out and out[-1][0] == "<number>":
            kind = "<unit>"
        else:
            kind = plain.lower()
        out.append((kind, plain.lower()))
    return out


def brute(doc, item, width):
    d, b = template(doc), template(item)
    w = min(width, len(b))
    pairs, at = {}, {}
    for j in range(len(b) - w + 1 if w else 0):
        at.setdefault(tuple(t for t, _ in b[j:j + w]), []).append(j)
    if {tuple(v for _, v in d[i:i + w]) for i in range(len(d) - w + 1)} & {tuple(v for _, v in b[j:j + w]) for js in at.values() for j in js}:
        return "verbatim"
    for i in range(len(d) - w + 1):
        for j in at.get(tuple(t for t, _ in d[i:i + w]), []):
            x, y = d[i:i + w], b[j:j + w]
            if 2 * sum(t[0] != "<" for t, _ in y) >= w:
                pairs.setdefault(i - j, set()).update((q, p) for (t, p), (_, q) in zip(x, y) if t[0] == "<")
    good = [s for s in pairs.values() if len({a for a, _ in s}) == len(s) == len({b for _, b in s})]
    return "verbatim" if any(all(a == b for a, b in s) for s in good) else "reparameterised" if good else None


ITEMS = ["A train travels 60 km in 2 hours while Alice walks 5 km home. How far apart are they then?",
         "If 3 apples and 3 pears cost 7 dollars, how many apples does Bob buy for 21 dollars today?",
         "short item here", "", None, "plain words only in this longer benchmark question about nothing at all"]
DOCS = ["Intro text. A train travels 60 km in 2 hours while Alice walks 5 km home. How far apart are they then? More.",
        "noise A train travels 90 miles in 4 hours while Carol walks 7 miles home. how far apart are they then",
        "if 4 apples and 5 pears cost 7 dollars, how many apples does Zoe buy for 21 dollars today",  # 3 is both 4 and 5, eight words equal
        "if 4 apples and 5 pears cost 8 dollars, how many apples does Zoe buy for 21 dollars today",  # 3 is both 4 and 5
        "If 3 apples and 4 pears cost 7 dollars, how many apples does Bob buy for 21 dollars today?",  # one 3 changed
        "if 4 apples and 4 pears cost 9 dollars, how many apples does Zoe buy for 30 dollars today",
        "we saw a short item, here: indeed", "a short text", "words only in this longer benchmark question about", "only in this longer benchmark question"]


def run(spark, docs, items, **how):
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    out = contaminated(documents(spark, docs), bench, **how).collect()
    for r in out:
        assert r["contaminated"] == bool(r["items"]) and r["n_items"] == len(r["items"])
    return {r["doc_id"]: {i["item"]: i["kind"] for i in r["items"]} for r in out}


def test_against_brute_force(spark):
    want = {d: {i: k for i, b in enumerate(ITEMS) if (k := brute(t or "", b or "", 8))} for d, t in enumerate(DOCS)}
    assert run(spark, DOCS, ITEMS) == want
    assert [want[d].get(0) for d in (0, 1)] == ["verbatim", "reparameterised"]
    assert [want[d].get(1) for d in (2, 3, 4, 5)] == ["verbatim", None, "verbatim", "reparameterised"]
    assert want[6].get(2) == "verbatim"


def test_a_table_and_awkward_texts(spark):
    docs = [r["text"] for r in given(spark, "documents").orderBy("doc_id").collect()][:120] + AWKWARD
    items = [r["text"] for r in given(spark, "benchmark").orderBy("item_id").collect()]
    docs += [items[0] + " and more", "before " + items[1]] + docs[:3]
    got = run(spark, docs, items)
    for d, t in enumerate(docs):
        assert set(got[d]) == {i for i, b in enumerate(items) if brute(t or "", b, 8)}, d


def test_empty_tables(spark):
    assert run(spark, [], ITEMS) == {}
    assert run(spark, DOCS[:2], []) == {0: {}, 1: {}}
    none = spark.createDataFrame([], "item_id string, text string")
    assert contaminated(documents(spark, DOCS), none).schema["items"].dataType.elementType["item"].dataType.simpleString() == "string"


def test_decontaminate_keeps_clean_rows_and_columns(spark):
    bench = spark.createDataFrame([(0, ITEMS[0])], "item_id long, text string")
    docs = documents(spark, DOCS + AWKWARD + [DOCS[0]], [None, *range(1, len(DOCS) + len(AWKWARD)), 1])
    out = decontaminate(docs, bench)
    assert out.columns == docs.columns
    assert sorted(str(r["text"]) for r in out.collect()) == sorted(map(str, DOCS[2:] + AWKWARD))


def test_main_path_is_native(spark):
    bench = spark.createDataFrame([(0, ITEMS[0])], "item_id long, text string")
    plan = contaminated(documents(spark, DOCS), bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def literal(text):
    return [p for w in words(text) if (p := "".join(c for c in w if c not in MARKS).lower())]


def shares_words(doc, item, width=8):
    """Brute force that knows no templates: some window of equal words."""
    d, b = literal(doc), literal(item)
    w = min(width, len(b))
    spans = {tuple(b[j:j + w]) for j in range(len(b) - w + 1)}
    return w > 0 and any(tuple(d[i:i + w]) in spans for i in range(len(d) - w + 1))


def test_copies_in_capitals_and_inside_sentences(spark):
    items = [ITEMS[0], ITEMS[5], "Why do cats purr at night?", "Seven ships sailed to Rome that old winter"]
    docs = [f(i) for i in items for f in (str.upper, str.title, str.lower, lambda i: "so he asked " + i, lambda i: "X " + i.upper() + " Y")]
    docs += ["WHY DO CATS", "another text of eight words and no copy"]
    want = {d: {i: "verbatim" for i, b in enumerate(items) if shares_words(t, b)} for d, t in enumerate(docs)}
    assert all(want[d] for d in range(20)) and not want[20] and not want[21]
    assert run(spark, docs, items) == want


def test_items_rich_in_values_and_passages_without(spark):
    items = ["3 + 4 = 7 and 5 + 6 = 11", "Anna Bob Carla Dora Emil Franz Greta Hans",
             "if 5 or 10 birds leave, the old grey tower near the harbour stands quiet until the next morning"]
    docs = ["sum: 3 + 4 = 7 and 5 + 6 = 11 it is", "sum: 3 + 4 = 8 and 5 + 6 = 12 it is", "list Anna Bob Carla Dora Emil Franz Greta Hans",
            "list Anna Bob Carla Dora Emil Franz Greta Otto",
            "if 4 or 4 birds leave, the old grey tower near the harbour stands quiet until the next morning"]
    assert run(spark, docs, items) == {0: {0: "verbatim"}, 1: {0: "reparameterised"}, 2: {1: "verbatim"}, 3: {}, 4: {2: "verbatim"}}


def test_hit_lists_do_not_grow_with_items_or_equal_rows(spark, monkeypatch):
    lead = "please read the following short question with care and answer"
    items = [f"{lead} part {chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    dump = " ".join(items)
    longest = []

    def kept(df, name, real=decontamination.stored):
        out = real(df, name)
        if name == "document-hits":
            longest.append(out.agg(F.max(F.size("hits"))).first()[0])
        return out

    monkeypatch.setattr(decontamination, "stored", kept)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = contaminated(documents(spark, [dump] * 4, [1, 1, 1, 2]), bench).collect()
    assert [len(r["items"]) for r in rows] == [60] * 4
    assert longest and max(longest) <= 2 * len(words(dump))
