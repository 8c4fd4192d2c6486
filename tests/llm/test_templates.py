"""op13 on made pages and against a plain reading of the given ones."""

import html
import re

from conftest import SMALL

from muniscope.llm import templates
from muniscope.llm.queries import QUERIES


def read(source):
    return templates.text_of(templates.content(templates.parse(source)), frozenset())


def test_rules():
    assert read("<body><nav>a</nav><article><h1>T &amp; U</h1><p>one<br>two <b>th</b>ree<p>four&nbsp;&eacute;&#233;&amp</article><footer>f</footer>") == "T & U\n\none two three\n\nfour éé&"
    assert read('<div class="sidebar"><p>s</p></div><article><div id=share-box>x</div><p>a</p><form>b</form><aside>c</aside><script>"</p>"</script><p>d</article>') == "a\n\nd"
    assert read('<article>x<section class="comments"><article class="comment">no</article></section></article><article class="comment">no</article>') == "x"
    assert read('<main><header><p>by</p><div><h1>Head</h1></div></header><p>t <span class="comment">kept</span></p></main>') == "Head\n\nt kept"
    assert read('<div class="widget-page"><article>in</article></div>') == "in"
    assert read('<article>main</article><div class="related"><article>teaser</article></div>') == "main"
    assert read("<head><title>t</title><p>body without end<div>x</div><header>h</header>") == "body without end\n\nx"
    assert read("<article><ul><li>a<li>b <i>c</i></ul><table><tr><td>1<td>2<tr><td>3</table><pre>x\n  y</pre></article>") == "a\n\nb c\n\n1 2\n\n3\n\nx y"
    assert read("<article>a < b <3 <!-- no <p> --> c<!-- open") == "a < b <3 c" and read("<article><a title='x>y'>l</a><a b=\"c>d</article>").startswith("l")
    assert read("") == "" and read("plain &lt;text&gt;") == "plain <text>" and read("<script>never ended <p>x") == ""
    deep = "<div>" * 50_000 + "x"
    assert read("<article>" + deep) == "x" and templates.hash_blocks(templates.content(templates.parse(deep)))


def page(i, text, notice):
    return f'<body><div class="box"><div class="n{i}">{notice}</div><p>{text}</p><p>again {i % 3}</p></div></body>'


def test_site_templates(spark):
    rows = [(i, f"http://A.example/{i}", page(i, f"text {i}", "<p>We use <b>things</b>.</p>")) for i in range(12)]
    rows += [(100 + i, f"https://b.example:80/{i}", page(0, "the same text", "<p>Notice</p>")) for i in range(40)]  # copies of one page
    rows += [(200 + i, f"http://c.example/{i}", page(i, f"few {i}", "<p>Few</p>")) for i in range(9)]
    rows += [(300, None, page(1, "no host", "n")), (301, "x", None), (302, "http://a.example/z", ""), (302, "http://a.example/z", "")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string").selectExpr("*", "1 AS text", "2 AS host", "3 AS rest", "4 AS template")
    out = {}
    for r in templates.extract_text(df).collect():
        out.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"]) and r["rest"] == 3
    assert all(out[i] == [f"text {i}\n\nagain {i % 3}"] for i in range(12))
    assert all(out[100 + i] == ["Notice\n\nthe same text\n\nagain 0"] for i in range(40))
    assert all(out[200 + i] == [f"Few\n\nfew {i}\n\nagain {i % 3}"] for i in range(9))
    assert out[300] == ["n\n\nno host\n\nagain 1"] and out[301] == [""] and out[302] == ["", ""]
    assert templates.extract_text(df.limit(0)).count() == 0


def test_query(spark):
    got = {r["page_id"]: r for r in QUERIES["op13_html_text"](spark, SMALL).collect()}
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        inner = re.search(r"(?s)<article>(.*?)(?:</article>|$)", r["html"])[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"], got[r["page_id"]]["url"]) == (want, len(want), r["url"])
