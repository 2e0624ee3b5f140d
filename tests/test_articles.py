"""Facts of article pages on hand-made HTML."""

from threadloom.sources.articles import article_facts


def test_facts_by_source_of_truth(spark):
    ld = '<script type="application/ld+json">{}</script>'.format
    pages = [
        (1, "https://e.org/articles/skyfall-1/?x=1", '<body class="a postid-77 b"><meta content="A &amp; B" property="og:title"><h1 class="entry-title">no</h1><span class="author vcard"><a rel="author">Jo <b>Do</b></a></span>'
            + ld("[1]") + ld("{") + ld('{"@graph":[{"@type":"Person"}]}') + ld('{"@graph":[{"@type":"WebPage","datePublished":"2020","dateModified":"2021","description":" d  e ","image":["i1","i2"],"author":{"name":"no"}},{"@type":"Article","datePublished":"1999"}]}')),
        (2, "https://e.org/b", '<article id="post-5" class="post"><h1>The <i>H</i></h1><time class="entry-date" datetime="2019-01-02">x</time><meta name="description" content="md"><meta property="og:image" content="im">'
            + ld('{"image":{"url":"u"},"author":[{"name":"Al"}]}') + '<a rel="tag">t1</a><a rel="category tag">c1</a><a class="x">n</a>'),
        (3, "/c/", '<title>T</title><div class="authority">no</div><time class="entry-date">May 3</time><a class="post-category">k</a><p id="wpmem_restricted_msg">'),
        (4, None, None),
    ]
    found = {r.page_id: r for r in article_facts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert tuple(found[1])[1:] == ("skyfall-1", "77", "A & B", "Jo Do", "2020", "2021", "d e", "i1", [], [], False)
    assert tuple(found[2])[1:] == ("b", "5", "The H", "Al", "2019-01-02", None, "md", "u", ["t1", "c1"], ["c1"], False)
    assert tuple(found[3])[1:] == ("c", "c", "T", None, "May 3", None, None, None, [], ["k"], True)
    assert tuple(found[4])[1:] == ("", "", "", None, None, None, None, None, [], [], False)
