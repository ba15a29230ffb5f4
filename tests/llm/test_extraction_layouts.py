"""Hosts with many layouts: each that enough pages have gets a wrapper of its own."""

from __future__ import annotations

from ledgerloom.llm import extraction

PAGE = '<html><body><div class="top{k}"><a href=a>Home</a></div><div class="c{k}"><h1>T {i}</h1><p>{long}</p><p>Always said here {k}</p></div><div class="end{k}">Imprint {i}</div></body></html>'


def test_every_usual_layout_has_a_wrapper(table):
    rows = [(12 * i + k, f"http://a.example/{k}/{i}", PAGE.format(k=k, i=i, long=f"words {i} {k} " * 40)) for k in range(12) for i in range(6)]
    pages = table(rows, "page_id long, url string, html string", "pages")
    got = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    assert got == {12 * i + k: f"T {i}\n{(f'words {i} {k} ' * 40).strip()}" for k in range(12) for i in range(6)}
