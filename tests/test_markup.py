import random

from folioscope.functions.json_text import find_category
from folioscope.functions.markup import link_table


def fold(tokens):
    """One event at a time."""
    out, href, words, titles = [], None, [], ""
    for kind, value in tokens:
        if kind == "open" and value and href is None:
            href, words, titles = value, [], f"t{value}"
        elif kind == "text":
            words.append(value)
        elif kind == "close" and href is not None:
            text = " ".join(" ".join(words).split())
            out.append((href, text, " ".join(p for p in (text, href, titles) if p)))
            href = None
    return out


def markup(tokens):
    write = {"open": lambda v: f'<A class="x" href="{v}" title="t{v}">' if v else "<a name='n'>", "close": lambda v: "</a>",
             "text": lambda v: f"<b>{v}</b>" if v.strip() else v, "other": lambda v: "<!-- <a href='no'>no</a> --><img>"}
    return "".join(write[k](v) for k, v in tokens)


def test_links_equal_a_fold_over_events():
    """Nested, unclosed, stray and empty anchors in any order."""
    rng = random.Random(11)
    pages, want = [], []
    for page in range(300):
        tokens = [(k, f"u{page}-{i}" if k == "open" and rng.random() < 0.8 else f"w{i}\n " if k == "text" else "")
                  for i, k in enumerate(rng.choices(["open", "close", "text", "other"], [3, 3, 4, 1], k=rng.randrange(0, 30)))]
        pages.append(markup(tokens))
        want += [(page, pos, *link) for pos, link in enumerate(fold([t for t in tokens if t[0] != "other"]))]
    assert [tuple(r) for r in link_table(pages).itertuples(index=False)] == want


def test_self_closed_blank_and_null_pages():
    rows = link_table([None, "", '<a href=" x "/>tail</a>', '<a href="  ">no</a><a href="y">one <i>two</i>', "<script><a href='z'>s</a></script>",
                       '<a href="p&amp;q" aria-label="L" data-title="D">A&nbsp;B</a>'])
    assert [tuple(r) for r in rows.itertuples(index=False)] == [(2, 0, "x", "", "x"), (5, 0, "p&q", "A B", "A B p&q L D")]


def test_category_is_the_first_in_page_order(spark):
    tree = '[{"n":"a","c":[{"n":"b","c":[{"n":"x","v":1}]},{"n":"x","v":2}]},{"n":"x","v":3}]'
    df = spark.createDataFrame([(tree,), ("[]",), (None,), ("no json",)], "t string")
    got = [r[0] for r in df.select(find_category("n", "c", "x")("t")).collect()]
    assert got == ['{"n": "x", "v": 1}', None, None, None]
