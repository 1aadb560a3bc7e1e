import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import leakage
from tallyloom.llm.wikitext import visible, words

ITEM = "Her vovibe clock loses 7007 seconds per hour, whereas the nulush clock gains 3972 seconds overnight in bedol."
W = words(ITEM)


def edit(a, b):
    """Least edit distance of the pattern to any stretch of the text, by the plain table."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=1, max_size=14), st.lists(st.sampled_from("abcd"), max_size=20))
def test_myers_is_the_edit_distance(a, b):
    assert leakage.myers(a, b) == edit(a, b)


def found(spark, docs, items=((1, ITEM),), **how):
    d = spark.createDataFrame([(i, t, "x", 5) for i, t in docs], "doc_id bigint, text string, passage string, item_id int")
    return sorted(map(tuple, leakage.leaks(d, spark.createDataFrame(list(items), "item_id bigint, passage string"), **how).collect()))


def test_markup_case_and_edits(spark):
    marked = "Her [[Vov|vovibe]] ''clock'' LOSES<br />7007<!-- no -->\nseconds <b>per</b> hour,<ref>n</ref> whereas&nbsp;the {{nowrap|nulush}} clock gains"
    table = "{|\n|-\n| Her vovibe || clock loses 7007\n|-\n| style=\"x\" | seconds per hour || whereas the nulush || clock\n|}"
    docs = [
        (1, "x " + " ".join(W[:12]) + " y"),
        (2, " ".join(W[:11]) + " other"),  # one word of a window changed
        (3, " ".join(W[:11])),
        (4, marked),
        (5, table),
        (6, " ".join(W[:6] + ["zzz"] + W[7:13])),
        (7, " ".join(W[:8] + ["q"] + W[8:10] + ["q"] + W[10:])),
        (8, None),
        (9, ""),
        (10, "<ref>" + ITEM + "</ref>"),
        (11, ("filler words " * 30_000) + ITEM),
        (12, "x " + " ".join(W[:12]) + " y"),
        (13, "{{quote|text=" + ITEM + "}} {{cn|date=May}}"),
        (14, " ".join(reversed(W))),
    ]
    got = found(spark, docs)
    assert {d for d, _, n in got if n == 0} == {1, 4, 5, 10, 11, 12, 13}
    assert {d for d, _, n in got if n == 1} >= {2, 3, 6}
    assert {7, 8, 9, 14}.isdisjoint(d for d, _, _ in got)


def test_short_items_crowded_filter_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(leakage, "BROADCAST_ITEMS", 1)
    monkeypatch.setattr(leakage, "MOST_BITS", 13)
    items = [(1, ITEM), (2, "too short"), (3, None), (4, ITEM)]
    assert found(spark, [(1, ITEM)], items) == [(1, 1, 0), (1, 4, 0)]
    assert found(spark, [], items) == [] and found(spark, [(1, ITEM)], [(2, "")]) == []


def test_windows_against_brute_force():
    rng = random.Random(9)
    own = [f"w{i}" for i in range(20)]
    known = leakage.Item(own, 12, 1)
    for _ in range(300):
        a = rng.randint(0, 8)
        text = [*rng.choices("xyz", k=3), *own[a : a + rng.randint(9, 14)], *rng.choices("xyz", k=3)]
        if rng.random() < 0.5:
            text[rng.randrange(len(text))] = "x"
        best = min(edit(own[i : i + 12], text) for i in range(9))
        assert known.distance(text) == min(best, 2)


def test_visible_text_survives_broken_markup():
    for t in ("[[a", "{{a|b", "<b", "<!-- x", "{|", "'''''", "&amp;amp; &bogus;", "]]}}", "<ref>x"):
        list(visible(t))
    assert words("Café café under_score x­y") == ["café", "café", "under", "score", "xy"]


def test_links_in_links_and_long_argument_names():
    deep = "[[a|" * 9 + "hello world" + "]]" * 9
    assert [w for part in visible(f"x {deep} y") for w in words(part)] == ["x", "hello", "world", "y"]
    assert [w for part in visible("{{box|" + "a rather long name of an argument that goes on" + "=value}}") for w in words(part)] == ["value"]


def test_many_items_against_every_window(spark):
    """More items than the filter has room for, in texts that hold pieces, edited windows and whole windows."""
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(10, 30)))) for i in range(60)]
    docs = []
    for d in range(80):
        text = rng.choices(vocabulary, k=rng.randint(0, 30))
        for _ in range(rng.randint(0, 2)):
            own = items[rng.randrange(60)][1].split(" ")
            at = rng.randrange(max(1, len(own) - 11))
            piece = own[at : at + rng.randint(6, 14)]
            if rng.random() < 0.5:
                piece[rng.randrange(len(piece))] = "zz"
            text += [*piece, *rng.choices(vocabulary, k=3)]
        docs.append((d, " ".join(text)))
    want = []
    for d, t in docs:
        for i, p in items:
            own = p.split(" ")
            best = min((edit(own[s : s + 12], t.split(" ")) for s in range(len(own) - 11)), default=9)
            if best <= 1:
                want.append((d, i, best))
    assert found(spark, docs, items) == sorted(want) and len(want) > 10
