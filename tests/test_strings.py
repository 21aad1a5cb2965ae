"""String functions, normalisation, text, interpolation."""

from __future__ import annotations

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import body_inner, nodes, one, table
from pageframe.functions import node as N, text as T
from pageframe.operators import axes, normalize, shred, text, tokens

KEEPERS = ("pre", "textarea", "script", "style", "code")


def test_string_normaliser(spark):
    f = lambda s, **k: one(spark, T.normalize_html_string(F.lit(s), **k))
    assert f("<ol>\n\t<li>first item</li>\r\n  <li> second </li>\n</ol>\n") == "<ol><li>first item</li><li> second </li></ol>"
    for tag in KEEPERS:
        kept = f"<{tag}>\n  two  spaces\n\n</{tag}>"
        assert f(f"<section> {kept} <i>z</i> </section>") == f"<section>{kept}<i>z</i></section>"
    noted = "<nav> <!-- first --> <a>x</a>\n<!-- last --></nav>"
    assert f(noted) == "<nav><!-- first --><a>x</a><!-- last --></nav>"
    assert f(noted, remove_comments=True) == "<nav><a>x</a></nav>"
    assert f(noted, remove_comments=True, remove_whitespace_text_nodes=False) == "<nav>  <a>x</a>\n</nav>"
    assert f("<i> <!-- never closed <u> </u>") == "<i><!-- never closed <u> </u>"
    assert f("<i> <code > not closed <u> ") == "<i><code > not closed <u> "
    assert f("<i> <u  cut") == "<i><u  cut"
    assert f("<CODE> </CODE> <codes> </codes>") == "<CODE></CODE><codes></codes>"


PIECES = st.lists(st.sampled_from([
    "<", ">", "<p>", "</p>", "<pre>", "</pre>", "<pre x>", "<code>", "</code>", "<!--", "-->", "<!-- c -->", " ", "\n", "\t",
    "a", "<b a", " ", "<script>", "</script>", "-", "<style >"]), max_size=14).map("".join)


WHOLE = st.recursive(
    st.sampled_from(["word", " two words ", " ", "\n\t", "<br>", "<!-- note -->"] + [f"<{t}> a  <b \n</{t}>" for t in KEEPERS]),
    lambda inner: st.tuples(st.sampled_from(["p", "div", "ul"]), st.lists(inner, max_size=4)).map(lambda x: f"<{x[0]}>{''.join(x[1])}</{x[0]}>"),
    max_leaves=8)


def test_string_normaliser_properties(spark):
    """Kept bodies and words survive, blank text between tags and unwanted comments go, a second pass changes nothing."""
    samples = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.lists(WHOLE, max_size=5).map("".join))
    def collect(s):
        samples.append(s)

    collect()
    df = table(spark, samples)
    for comments in (False, True):
        once = T.normalize_html_string(F.col("html"), remove_comments=comments)
        for r in df.select("html", once.alias("n"), T.normalize_html_string(once, remove_comments=comments).alias("again")).collect():
            assert r.again == r.n
            assert len(r.n) <= len(r.html)
            bodies = re.compile("|".join(f"<{t}>.*?</{t}>" for t in KEEPERS), re.S)
            assert bodies.findall(r.n) == bodies.findall(r.html)
            outside, before = bodies.sub("<x>", r.n), bodies.sub("<x>", r.html)
            assert not re.search(r">[ \t\r\n]+<", outside) and outside.split() == outside.split()
            assert outside.count("<!--") == (0 if comments else before.count("<!--"))
            if comments:
                before = before.replace("<!-- note -->", "")
            assert re.sub(r"\s", "", outside) == re.sub(r"\s", "", before)


def test_string_normaliser_leaves_broken_markup_whole(spark):
    """Whatever the input, nothing but blanks and, if asked, comments is lost."""
    samples = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(PIECES)
    def collect(s):
        samples.append(s)

    collect()
    df = table(spark, samples)
    for r in df.select("html", T.normalize_html_string(F.col("html")).alias("n")).collect():
        assert re.sub(r"\s", "", r.n) == re.sub(r"\s", "", r.html)
    kept = T.normalize_html_string(F.col("html"), remove_comments=False, remove_whitespace_text_nodes=False)
    assert df.where(kept != F.col("html")).count() == 0


def test_tokens_tile_the_input(spark):
    samples = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(PIECES)
    def collect(s):
        samples.append(s)

    collect()
    df = table(spark, samples)
    tok = tokens.tokenize(df).groupBy("page_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "raw"))), lambda x: x["raw"]), "").alias("again"))
    assert df.filter("html <> ''").join(tok, "page_id", "left").filter("again is null or again <> html").count() == 0
    assert shred.shred_errors(shred.shred(df)).count() == 0


def test_text_functions(spark):
    assert one(spark, T.normalize_text(F.lit("\n one\t\ttwo   three \r\n"))) == "one two three"
    assert one(spark, T.normalize_text(F.lit("<p> a </p> \n <b>x</b>"))) == "<p> a </p><b>x</b>"
    assert one(spark, T.escape_html(F.lit("5 < 6 && 'a' > \"b\""))) == "5 &lt; 6 &amp;&amp; &#39;a&#39; &gt; &quot;b&quot;"
    flags = lambda s: tuple(one(spark, f(F.lit(s))) for f in (N.is_whitespace_only, N.is_text_empty, N.is_collapsible_ws))
    assert flags("") == (True, True, True) and flags(" \n") == (True, True, False)
    assert flags("\n\t\r") == (True, True, True) and flags("\f") == (True, False, False) and flags(" a") == (False,) * 3


def test_interpolation(spark):
    m = F.create_map(F.lit("who"), F.lit("R & D"), F.lit("n"), F.lit("7"), F.lit("t"), F.lit("<b> {n}"))
    assert one(spark, T.interpolate(F.lit("{n}. {who} wrote {t} in {year} {"), m)) == "7. R &amp; D wrote &lt;b&gt; {n} in {year} {"
    raw = F.create_map(F.lit("t"), F.lit("<b> {n}"), F.lit("n"), F.lit("7"))
    assert one(spark, T.interpolate(F.lit("{t} {n}"), raw, escape=False)) == "<b> 7 7"


def test_dom_normalisation(spark):
    article = "<article><!-- top --><h2>A  b</h2><code> x  y </code><q> c </q></article>"
    spaced = "<article>\n<!-- top -->\n\t<h2>A  b</h2>\r<code> x  y </code>\n<q> c </q>\n</article>"
    n = nodes(spark, spaced)
    assert body_inner(normalize.normalize_dom(n)) == [article]
    assert body_inner(normalize.normalize_dom(n, skip_comments=True)) == [article.replace("<!-- top -->", "")]
    indented = spaced.replace("\n\t<h2>", "\n    <h2>")
    assert body_inner(normalize.normalize_dom(nodes(spark, indented))) == [article.replace("<h2>", "\n    <h2>")]
    assert body_inner(normalize.normalize_for_display(nodes(spark, indented))) == [article.replace("<!-- top -->", "")]
    inner = nodes(spark, "<section><template>\n<!-- in --><u>\n</u></template>\n</section>")
    assert body_inner(normalize.normalize_dom(inner, skip_comments=True)) == ["<section><template><u></u></template></section>"]


def test_text_content(spark):
    n = nodes(spark, "<section>The <u>quick</u> fox<!-- not this --><p>runs<em>!</em></p><template>nor this</template></section>",
              "<section><!--one-->k<!----><!-- two\nlines --></section>")
    rows = text.text_content(n, "section").orderBy("page_id").collect()
    assert [r.text_content for r in rows] == ["The quick foxruns!", "k"]
    own = text.text_content(n, F.col("node_type") == "comment").orderBy("page_id", "pre").collect()
    assert [r.text_content for r in own] == [" not this ", "one", "", " two\nlines "]
    assert text.comment_content(n).count() == 4


def test_node_emptiness(spark):
    empty, full = ["<h3></h3>", "<i>\t </i>", "<hr>", "<ul> \n </ul>", "<style></style>"], ["<b>x</b>", "<ol><li></li></ol>"]
    n = axes.node_empty(nodes(spark, "<p>" + "".join(empty + full)))
    got = {r.tag: r.is_empty for r in n.filter("node_type = 'element' and in_body").collect()}
    assert all(got[t] for t in ("h3", "i", "hr", "ul", "style")) and not any(got[t] for t in ("b", "body"))
