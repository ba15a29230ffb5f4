from __future__ import annotations

import pytest

from ledgerloom.llm import extraction


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<body class="has-sidebar"><p>a</p></body>', "a"),
        ('<html class="no-sidebar"><body class="sidebar"><article><p>a</p></article><div class="sidebar">s</div></body></html>', "a"),
        ('<h2 id="related-work">Related work</h2><p>a</p>', "Related work\na"),
        ('<h2 id="comments">On comments</h2><div id="search"><p>a</p></div>', "On comments\na"),
        ('<div class="navy-history">a</div><div class="promotion">b</div><p class="alerts-of-war">c</p><p id="notices">d</p>', "a\nb\nc\nd"),
        ("<article><p>a</p></article><nav>n</nav><article><p>longer text</p></article>", "a\nlonger text"),
        ("<main><article><p>a</p></article></main><main><p>b</p></main>", "a\nb"),
        ('<div class="modal"><article><p>a</p></article></div>', "a"),
        ('<form><article class="ad"><p>x</p></article><main><p>a</p></main></form>', "x\na"),
        ('<article><p>a</p><div class="ad">x</div><div id="comments"><article class="comment">y</article></div><div class="top-nav wide">z</div></article>', "a"),
        ('<p>a</p><div class="cookie-notice">x</div><div role="navigation">y</div><div hidden>z</div><div class="site-footer">f</div>', "a"),
    ],
)
def test_only_whole_marks_are_noise_and_all_articles_stay(page, text):
    assert extraction._text(page) == text
