"""Pages of plain tags are cut by one pattern; every other page is left to the parser, and both give the same nodes."""

from noticelake.sources.html import _Nodes

PLAIN = [
    "", "text alone &lt;", '<p id="a" class="b c">x &lt; y</p> tail &amp;', '<TABLE><tr><td data-title="標題">一<br/>二<img src="i"></td></tr></table>',
    '<a href="?p=1&amp;w=2" href="z">A</a></div>',
]
OTHER = [
    "a < b", "<!-- <p> -->", "<p id='a'>", "<a href=x>", '<a href="?copy=1&copy=2">', "<title><b></title>", "<script>if (a<b) {}</script>", "</p x>", "<p",
    '<p id="a"id="b">',
]


def test_plain_pages_are_cut_without_the_parser():
    for page in PLAIN + OTHER:
        parsed = _Nodes()
        parsed.feed(page)
        parsed.close()
        parsed._close_to(0)
        read = _Nodes.of(page)
        assert (read.nodes, read.strings) == (parsed.nodes, parsed.strings), page
        assert _Nodes()._plain(page) == (page in PLAIN), page
