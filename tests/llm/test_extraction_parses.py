"""A page is parsed for its outline and for its text, and never a third time."""

from __future__ import annotations

import re

from ledgerloom.llm import extraction, shared

PAGE = '<html><body><div class=top><a href=a>Home</a></div><div class=c><h1>T {i}</h1><p>{long}</p><p>Always said here</p></div><div class=end>Imprint {i}</div></body></html>'


def said(i):
    return f"T {i}\n{(f'words {i} ' * 40).strip()}"


def test_html_goes_to_python_twice_and_copies_are_dealt(table, monkeypatch):
    """Half a thousand copies of one page are more than a task's share of one key; they count once in the wrapper."""
    rows = [(i, f"http://a.example/{i}", PAGE.format(i=min(i, 9), long=f"words {min(i, 9)} " * 40)) for i in range(500)]
    pages = table(rows, "page_id long, url string, html string", "pages")
    plans, kept, hot = [], shared.materialize, []

    def keep(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    def dealt(groups, keys, weight):
        found = hot_keys(groups, keys, weight)
        hot.append((weight, found is not None))
        return found

    hot_keys = shared.hot_keys
    monkeypatch.setattr(shared, "materialize", keep)
    monkeypatch.setattr(shared, "hot_keys", dealt)
    got = extraction.extract(pages)
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert len(re.findall(r"(?:ArrowEvalPython|MapInArrow) [^\n]*\bhtml#", "\n".join(plans))) == 2
    assert ("copies", True) in hot
    assert {r.page_id: (r.text, r.n_chars, r.n_template) for r in got.collect()} == {i: (said(min(i, 9)), len(said(min(i, 9))), 3) for i in range(500)}


def test_tags_whose_quotes_pair_or_not():
    assert extraction._text('<p title="a>b">x</p><p title=\'c"d>\'>y</p>') == "x\ny"
    assert extraction._text('<p>x</p><p title="a>y</p><div class="ad">z</div><p>w</p>') == "x\ny\nw"
    assert extraction._text('<p>x</p><p title="a>y</p><p>1 < 2</p><div class=ad>z</div><p title="c>d">w</p>') == 'x\nd">w'
