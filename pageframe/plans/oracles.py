"""The same results as plain SQL over the given tables."""

from __future__ import annotations


def _txt(x: str) -> str:
    """Character data with the entities of the corpus decoded."""
    return f"replace({_ser(x)},'&amp;','&')"


def _ser(x: str) -> str:
    """Markup as the serialiser writes it: only &amp; stays escaped in text."""
    return f"replace(replace(replace({x},'&copy;','©'),'&middot;','·'),'&quot;','\"')"


def _one(tag: str, col: str = "html") -> str:
    return f"regexp_extract({col},'(?s)<{tag}>(.*?)</{tag}>',1)"


def _n(what: str) -> str:
    return f"len(regexp_extract_all(html,'{what}'))"


NAV = "regexp_extract(html,'(?s)(<nav>.*?</nav>)',1)"
NAV_OUT = _ser(NAV)
ITEMS = """WITH l AS (
  SELECT page_id, url, regexp_extract_all(html,'<li><a href="([^"]*)">',1) AS h,
         regexp_extract_all(html,'<li><a href="[^"]*">([^<]*)</a></li>',1) AS t FROM pages),
items AS (SELECT page_id, url, len(h) AS n, unnest(h) AS href, unnest(t) AS txt, unnest(range(1, len(h) + 1)) AS i FROM l)
"""
NOTAGS = "regexp_replace({},'<[^>]*>','','g')"
KEEP_RX = ("(?s){c}({k}<(?:script|style)(?: [^>]*)?>.*?</(?:script|style)>|<[^>]*>|[ \\t\\n\\r]*[^< \\t\\n\\r][^<]*)"
           "|[ \\t\\n\\r]+")
NORMAL = KEEP_RX.format(c="", k="<!--.*?-->|")
NORMAL_NO_COMMENTS = KEEP_RX.format(c="<!--.*?-->|", k="")
TOKENS = ("(?is)<!--.*?-->|<(?:script|style)[^>]*>.*?</(?:script|style)>|<title[^>]*>.*?</title>"
          "|<[!?][^>]*>|</?[a-z][^>]*>|[^<]+|<")
CODE = "regexp_replace(html,'(?s)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>','','g')"


def _part_markup(div_attrs, before, first_link, second_style, card, svg_attr, animate) -> str:
    return f"""SELECT p_partkey AS page_id, '<div{div_attrs} class="c' || p_size || '" data-k="' || p_partkey || '">'
    || {before} || '<a{first_link} title="' || p_name || '">' || p_name || '</a><a href="/p/' || p_partkey
    || '" target="_top"{second_style}>go</a>' || {card} || '<svg viewBox="0 0 1 1"{svg_attr}><circle r="1"></circle>{animate}</svg></div>' AS html
    FROM part"""


COMMENT = "'<!-- ' || p_brand || ' -->'"
CARD = "'<x-card size=\"1\">' || p_type || '</x-card>'"
STRICT = _part_markup("", "''", "", "", "''", "", "")


def _positions(where: str) -> str:
    return ITEMS + f"SELECT page_id, i AS elem_idx FROM items WHERE {where}"


def _per_page(count: str) -> str:
    return f"SELECT page_id, n FROM (SELECT page_id, {count} AS n FROM pages) WHERE n > 0"


def _nav(expr: str) -> str:
    return f"SELECT page_id, {expr} AS outer_html FROM pages"


# `b` elements by the tree rules: one left open is repeated in the blocks that follow, three at most.
BOLD = f"""WITH b AS (
          SELECT page_id, regexp_extract_all({_one('article')},'<p>(?:<b>)?') AS x FROM pages),
        p AS (SELECT page_id, unnest(x) AS blk, unnest(range(1, len(x) + 1)) AS i FROM b),
        r AS (SELECT page_id, i, (blk = '<p><b>')::INT AS own,
            coalesce(sum((blk = '<p><b>')::INT) OVER (PARTITION BY page_id ORDER BY i
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p),
        t AS (SELECT page_id, sum(least(before, 3) + own) + least(sum(own), 3) AS n FROM r GROUP BY 1)
        SELECT page_id, n::BIGINT AS n FROM t WHERE n > 0"""
TAGS = "SELECT unnest(regexp_extract_all(html,'<([a-z][a-z0-9]*)(?: [^>]*)?>',1)) AS tag FROM pages"


def _parts_of_page() -> str:
    """page_id, tag, outer_html of the parts that the tree rules leave as written."""
    rx = {"head": "(?s)(<head>.*?</head>)", "nav": "(?s)(<nav>.*?</nav>)", "div": "(?s)(<div class=\"ad\">.*?</div>)", "footer": "(?s)(<footer>.*?</footer>)"}
    each = " UNION ALL ".join(f"SELECT page_id, '{t}' AS tag, {_ser(f'regexp_extract(html, {chr(39)}{r}{chr(39)}, 1)')} AS outer_html FROM pages" for t, r in rx.items())
    return f"SELECT * FROM ({each}) WHERE outer_html <> ''"


ORACLES = {
    "tokens_by_kind": f"""WITH t AS (SELECT unnest(regexp_extract_all(html, '{TOKENS}')) AS raw FROM pages)
        SELECT CASE WHEN starts_with(raw,'<!--') THEN 'comment' WHEN lower(raw) LIKE '<!doctype%' THEN 'doctype'
          WHEN regexp_matches(raw,'(?is)^<(script|style|title)') THEN 'raw' WHEN starts_with(raw,'</') THEN 'end'
          WHEN regexp_matches(raw,'^<[a-zA-Z]') THEN 'start' ELSE 'text' END AS kind,
          count(*) AS n, sum(length(raw))::BIGINT AS n_chars FROM t GROUP BY 1""",
    "start_tag_counts": f"""WITH t AS (SELECT unnest(regexp_extract_all(html, '{TOKENS}')) AS raw FROM pages)
        SELECT lower(regexp_extract(raw,'^<([a-zA-Z][^ />]*)',1)) AS tag, count(*) AS n FROM t
        WHERE regexp_matches(raw,'^<[a-zA-Z]') GROUP BY 1""",
    "token_attributes": """WITH a AS (
        SELECT 'lang' AS name, unnest(regexp_extract_all(html,'<html lang="([^"]*)"',1)) AS value FROM pages
        UNION ALL SELECT 'charset', unnest(regexp_extract_all(html,'<meta charset="([^"]*)"',1)) FROM pages
        UNION ALL SELECT 'href', unnest(regexp_extract_all(html,'<a href="([^"]*)"',1)) FROM pages
        UNION ALL SELECT 'class', unnest(regexp_extract_all(html,'<div class="([^"]*)"',1)) FROM pages)
        SELECT name, value, count(*) AS n FROM a GROUP BY ALL""",
    "link_graph": ITEMS + """SELECT regexp_extract(url,'^https?://([^/?#]*)',1) AS from_host,
        regexp_extract(url,'^https?://([^/?#]*)',1) AS to_host, count(*) AS n_links FROM items GROUP BY ALL""",
    "normalize_string": f"SELECT page_id, regexp_replace(html, '{NORMAL}', '\\1', 'g') AS html FROM pages",
    "normalize_spaced": "SELECT page_id, html FROM pages",
    "strip_comments": f"SELECT page_id, regexp_replace(html, '{NORMAL_NO_COMMENTS}', '\\1', 'g') AS html FROM pages",
    "escape_text": """SELECT doc_id, replace(replace(replace(replace(replace(text,'&','&amp;'),'<','&lt;'),'>','&gt;'),
        '"','&quot;'),'''','&#39;') AS escaped FROM documents""",
    "normalize_text": r"""SELECT doc_id, trim(replace(regexp_replace(text,'[ \t\n\r\x0B\f]+',' ','g'),'> <','><'),' ') AS text
        FROM documents""",
    "whitespace_tests": r"""WITH s AS (SELECT unnest(string_split(text, chr(10))) AS s FROM documents)
        SELECT count(*) FILTER (regexp_full_match(s,'[ \t\n\r\x0B\f]*')) AS whitespace_only,
          count(*) FILTER (regexp_full_match(s,'[ \t\n\r]*')) AS text_empty,
          count(*) FILTER (regexp_full_match(s,'[\t\n\r]*')) AS collapsible,
          count(*) FILTER (contains(s,'the')) AS contains_the FROM s""",
    "tag_histogram": f"""WITH t AS ({TAGS})
        SELECT upper(tag) AS node_name, count(*) AS n, count(*) FILTER (tag IN ('br', 'meta')) AS n_void, count(*) AS n_known
        FROM t WHERE tag <> 'b' GROUP BY 1 UNION ALL SELECT 'B', sum(n)::BIGINT, 0, sum(n)::BIGINT FROM ({BOLD})""",
    "attr_histogram": """WITH a AS (
        SELECT 'html' AS tag, 'lang' AS name, unnest(regexp_extract_all(html,'<html lang="([^"]*)"',1)) AS value FROM pages
        UNION ALL SELECT 'meta', 'charset', unnest(regexp_extract_all(html,'<meta charset="([^"]*)"',1)) FROM pages
        UNION ALL SELECT 'a', 'href', unnest(regexp_extract_all(html,'<a href="([^"]*)"',1)) FROM pages
        UNION ALL SELECT 'div', 'class', unnest(regexp_extract_all(html,'<div class="([^"]*)"',1)) FROM pages)
        SELECT tag, name, count(*) AS n, count(DISTINCT value) AS n_values FROM a GROUP BY 1, 2""",
    "node_kinds": f"""SELECT 'comment' AS node_type, sum({_n('<!--')})::BIGINT AS n FROM pages
        UNION ALL SELECT 'doctype', sum({_n('<!DOCTYPE')})::BIGINT FROM pages""",
    "page_roots": """SELECT regexp_extract(html,'<html lang="([^"]*)"',1) AS lang, count(*) AS n FROM pages GROUP BY 1""",
    "bold_elements": BOLD,
    "comments": "SELECT page_id, unnest(regexp_extract_all(html,'(?s)<!--(.*?)-->',1)) AS text FROM pages",
    "elements_by_class": """SELECT page_id, 'div' AS tag, 'ad' AS class_string, 1::BIGINT AS n_classes FROM
        (SELECT page_id, unnest(regexp_extract_all(html,'<div class="ad">')) FROM pages)""",
    "elements_by_attribute": ITEMS + "SELECT page_id, count(*) AS n FROM items WHERE lower(href) = '/the' GROUP BY 1",
    "elements_with_attribute": ITEMS + "SELECT page_id, count(*) AS n FROM items GROUP BY 1",
    "elements_by_id_name": """SELECT p_partkey AS page_id, 'ul' AS tag, 'u' AS element_id FROM part
        UNION ALL SELECT p_partkey, 'input', '' FROM part""",
    "first_link": ITEMS + "SELECT page_id, href FROM items WHERE i = 1",
    "first_with_class": "SELECT page_id, 'div' AS tag FROM pages WHERE contains(html,'<div class=\"ad\">')",
    "first_by_attribute": ITEMS + "SELECT page_id, href FROM items WHERE i = 1",
    "first_by_id": "SELECT p_partkey AS page_id, 'ul' AS tag, 'list' AS cls FROM part",
    "first_by_data_attribute": "SELECT p_partkey AS page_id, p_partkey::VARCHAR AS k FROM part",
    "find_elements": ITEMS + "SELECT page_id, count(*) AS n FROM items WHERE length(href) > 6 GROUP BY 1",
    "find_first": ITEMS + "SELECT page_id, arg_min(href, i) AS href FROM items WHERE length(href) > 6 GROUP BY 1",
    "map_elements": f"""WITH t AS (SELECT unnest(regexp_extract_all(html,'<([a-z][a-z0-9]*(?: [^>]*)?)>',1)) AS tag FROM pages)
        SELECT regexp_extract(tag, '^[a-z0-9]+') || '.' || regexp_extract(tag, 'class="([^"]*)"', 1) AS label, count(*) AS n
        FROM t WHERE tag <> 'b' GROUP BY 1 UNION ALL SELECT 'b.', sum(n)::BIGINT FROM ({BOLD})""",
    "nav_links": ITEMS + "SELECT page_id, (14 + 3 * (i - 1))::INT AS pre, href FROM items",
    "link_hosts": ITEMS + """SELECT regexp_extract(url,'^https?://([^/?#]*)',1) AS host, count(*) AS n_links,
        count(DISTINCT page_id) AS n_pages FROM items GROUP BY 1""",
    "page_links": ITEMS + f"""SELECT page_id, href, {_txt('txt')} AS link_text,
        regexp_extract(url,'^(https?://[^/?#]*)',1) || href AS target FROM items""",
    "li_first": _positions("i = 1"),
    "li_last": _positions("i = n"),
    "li_nth_2n1": _positions("i % 2 = 1"),
    "li_nth_last": _positions("i > n - 2"),
    "li_after_second": _positions("i > 2"),
    "li_nth_of": ITEMS + """SELECT page_id, i AS elem_idx FROM (
        SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) AS k FROM items WHERE starts_with(href,'/t')) WHERE k % 2 = 0""",
    "adjacent_div_article": "SELECT page_id, 'article' AS tag FROM pages WHERE contains(html,'</div><article>')",
    "p_has_br": _per_page(_n("<br>")),
    "not_has": _per_page(f"{_n('<p>')} - {_n('<br>')}"),
    "selector_list": ITEMS + """SELECT 'a' AS tag, count(*) AS n FROM items UNION ALL SELECT 'li', count(*) FROM items WHERE i = 1
        UNION ALL SELECT unnest(['title','h1','footer']), count(*) FROM pages""",
    "attr_operators": ITEMS + f"""SELECT page_id, count(*) FILTER (starts_with(href,'/t')) AS prefix,
        count(*) FILTER (ends_with(href,'e')) AS suffix, count(*) FILTER (contains(href,'an')) AS part,
        count(*) FILTER (lower(href) = '/the') AS exact_ci, any_value(tok) AS token, any_value(d) AS dash, 0::BIGINT AS empty_operand
        FROM items JOIN (SELECT page_id, {_n('<div class="ad">')} AS tok,
          regexp_matches(html,'<html lang="en["-]')::INT::BIGINT AS d FROM pages) USING (page_id) GROUP BY page_id""",
    "match_counts": f"""SELECT page_id, {_n('<li>')} AS n_items, {_n('<p>')} AS n_paragraphs, {_n('<br>')} AS n_breaks,
        0::BIGINT AS n_never, least({_n('<p>')}, 1)::BIGINT AS n_first, {_n('<h1>')} AS n_only FROM pages""",
    "contains_text": ITEMS + "SELECT page_id, count(*) AS n FROM items WHERE contains(txt,'the') GROUP BY 1",
    "page_matches": "SELECT page_id, contains(html,'<a href=\"/The\">') AS matches FROM pages",
    "select_first": ITEMS + "SELECT page_id, arg_min(href, i) AS href FROM items WHERE starts_with(href,'/t') GROUP BY 1",
    "form_states": """SELECT p_partkey AS page_id, 2::BIGINT AS n_checked, 1::BIGINT AS n_disabled, 1::BIGINT AS n_required,
        3::BIGINT AS n_optional, 1::BIGINT AS n_shown, 2::BIGINT AS n_write, 2::BIGINT AS n_empty, 3::BIGINT AS n_blank,
        1::BIGINT AS n_class, 1::BIGINT AS n_enabled FROM part""",
    "select_within": f"""SELECT unnest(['nav','ul','article']) AS root_tag, unnest(['li','li','h1']) AS tag,
        unnest([li, li, h1]) AS n FROM (SELECT sum({_n('<li>')})::BIGINT AS li, sum({_n('<h1>')})::BIGINT AS h1 FROM pages)""",
    "filter_nodes": "SELECT unnest(['li','h1']) AS tag, k AS n FROM (SELECT count(*) AS k FROM pages)",
    "node_matches": f"""WITH c AS (SELECT page_id, {_n('<li>')} AS li, {_n('<a href="/t')} AS t, {_n('<div class="ad">')} AS div, {_n('<p>')} AS p, {_n('<br>')} AS br FROM pages),
        r AS (SELECT page_id, unnest(['html','head','meta','title','style','script','body','nav','ul','article','h1','footer','li','a','div','p','br','b']) AS tag,
            unnest([1,1,1,1,1,1,1,1,1,1,1,1,li,li,div,p,br,coalesce(n, 0)]) AS total, unnest([0,0,0,0,0,0,0,0,0,0,0,0,least(li, 1),t,div,br,0,0]) AS hit
            FROM c LEFT JOIN ({BOLD}) USING (page_id))
        SELECT page_id, tag, true AS matches, hit AS n FROM r WHERE hit > 0 UNION ALL SELECT page_id, tag, false, total - hit FROM r WHERE total > hit""",
    "list_children": f"SELECT page_id, {_n('<li>')} AS n_children FROM pages",
    "edge_children": ITEMS + """, c AS (SELECT page_id, count(*) AS k, sum(length(href))::BIGINT AS chars FROM items GROUP BY 1),
        ends AS (SELECT unnest(['first','last','first_element','last_element']) AS axis, unnest(['NAV','FOOTER','NAV','FOOTER']) AS edge)
        SELECT page_id, axis, edge AS name, 1::BIGINT AS n, 0::BIGINT AS n_chars FROM pages, ends
        UNION ALL SELECT page_id, axis, 'LI', 1, 0 FROM c, ends UNION ALL SELECT page_id, axis, 'A', k, chars FROM c, ends""",
    "sibling_axis": ITEMS + """, c AS (SELECT page_id, count(*) AS k FROM items GROUP BY 1),
        r AS (SELECT page_id, unnest(['next','previous','after_nav']) AS axis, unnest(['ARTICLE','#comment','DIV']) AS name, 1 AS n FROM pages
            UNION ALL SELECT page_id, 'next_item', 'LI', k - 1 FROM c UNION ALL SELECT page_id, 'previous_item', 'LI', k // 2 FROM c)
        SELECT page_id, axis, name, n::BIGINT AS n FROM r WHERE n > 0""",
    "parent_axis": f"SELECT page_id, 'ul' AS tag, {_n('<li>')} AS n FROM pages",
    "ancestor_axis": f"SELECT page_id, unnest(['li','ul','nav','body','html']) AS tag, {_n('<li>')} AS n FROM pages",
    "descendant_axis": f"""SELECT page_id, unnest(['UL','LI','A','#text']) AS name, unnest([1, k, k, k]) AS n
        FROM (SELECT page_id, {_n('<li>')} AS k FROM pages)""",
    "descendant_counts": f"SELECT page_id, 3 * {_n('<li>')} AS n_descendants FROM pages",
    "empty_nodes": """WITH k AS (SELECT * FROM (VALUES (0, 'P', false, 1), (0, '#text', true, 1), (1, 'P', true, 1), (1, '#text', true, 2), (1, '#comment', true, 1),
            (2, 'DIV', false, 1), (2, 'P', true, 1), (3, 'UL', false, 1), (3, 'LI', false, 1), (3, 'BR', true, 1), (3, '#text', true, 1)) v(c, name, is_empty, n)
            UNION ALL SELECT c, unnest(['HTML', 'HEAD', 'BODY']), unnest([false, true, false]), 1 FROM range(0, 4) t(c))
        SELECT p_partkey AS page_id, name, is_empty, n::BIGINT AS n FROM part JOIN k ON c = p_size % 4""",
    "title_text": f"SELECT page_id, {_txt(_one('title'))} AS text FROM pages",
    "h1_text": f"SELECT page_id, {_txt(_one('h1'))} AS text FROM pages",
    "footer_text": f"SELECT page_id, {_txt(_one('footer'))} AS text FROM pages",
    "main_text": f"""SELECT page_id, {_txt(_one('title'))} AS title, {_txt(_one('h1'))} AS heading,
        {_txt(NOTAGS.format(_one('article')))} AS article FROM pages""",
    "style_text": f"SELECT page_id, {_one('style')} AS text FROM pages",
    "script_text": f"SELECT page_id, {_one('script')} AS text FROM pages",
    "nav_html": _nav(NAV_OUT),
    "nav_inner_html": f"SELECT page_id, {_ser(_one('nav'))} AS inner_html FROM pages",
    "head_html": f"SELECT page_id, {_ser(chr(39).join(['regexp_extract(html,', '(?s)(<head>.*?</head>)', ',1)']))} AS outer_html FROM pages",
    "outline_nav": f"""SELECT page_id, unnest([3, 4, 5, 6])::BIGINT AS depth, unnest(['ul','li','a','#text']) AS name,
        unnest([1, k, k, k]) AS n FROM (SELECT page_id, {_n('<li>')} AS k FROM pages)""",
    "roundtrip": "SELECT page_id, true AS same_size, true AS same_nodes FROM pages",
    "normalize_dom": _parts_of_page(),
    "normalize_for_display": _parts_of_page(),
    "audit_parts": """SELECT tag, attr, verdict, (SELECT count(*) FROM part) AS n FROM (VALUES
        ('div','onclick','dangerous'), ('div','class','ok'), ('div','data-k','ok'), ('a','href','dangerous'), ('a','title','ok'),
        ('a','href','ok'), ('a','target','ok'), ('a','style','ok'), ('x-card','size','ok'), ('x-card','onload','dangerous'),
        ('svg','viewBox','ok'), ('svg','onload','dangerous'), ('circle','r','ok')) t(tag, attr, verdict)""",
    "audit_joined": f"""SELECT unnest(['html','meta','a','div']) AS tag, unnest(['lang','charset','href','class']) AS name,
        true AS listed, unnest([k, k, a, d]) AS n FROM (SELECT count(*) AS k, sum({_n('<a href')})::BIGINT AS a,
        sum({_n('<div class')})::BIGINT AS d FROM pages)""",
    "attribute_rules": """WITH t AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'button' ELSE 'x-card' END AS tag,
          CASE p_type WHEN 'ECONOMY' THEN 'href' WHEN 'SMALL' THEN 'disabled' WHEN 'LARGE' THEN 'hx-get'
            WHEN 'STANDARD' THEN 'onclick' ELSE 'lang' END AS attr FROM part)
        SELECT p_partkey, tag, attr,
          CASE attr WHEN 'hx-get' THEN true WHEN 'href' THEN tag = 'a' WHEN 'disabled' THEN tag = 'button'
            WHEN 'lang' THEN tag IN ('a','button') ELSE false END AS allowed,
          CASE attr WHEN 'hx-get' THEN true WHEN 'href' THEN tag = 'a' WHEN 'lang' THEN tag IN ('a','button') ELSE false END AS valid,
          attr <> 'onclick' AS known, CASE WHEN attr = 'hx-get' THEN 'HTMX' END AS framework FROM t""",
    "allowed_attributes": f"""WITH t AS ({TAGS}), c AS (SELECT tag, count(*) AS n FROM t WHERE tag <> 'b' GROUP BY 1 UNION ALL SELECT 'b', sum(n)::BIGINT FROM ({BOLD}))
        SELECT tag, n AS n_nodes, CASE tag WHEN 'a' THEN 24 WHEN 'div' THEN 61 WHEN 'p' THEN 61 WHEN 'meta' THEN 21 ELSE 16 END::BIGINT AS n_attrs
        FROM c WHERE tag NOT IN ('style', 'script')""",
    "dangerous_values": """WITH v AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'JavaScript:' ELSE '' END || replace(url,'https:','') AS value FROM pages)
        SELECT page_id, value, starts_with(value,'JavaScript:') OR starts_with(value,'//') AS dangerous FROM v""",
    "safe_uri": """WITH r AS (SELECT page_id, url, regexp_replace(url,'^https?://[^/]*','') AS rel FROM pages),
        t AS (SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN rel ELSE substring(rel, 2) END AS tail FROM r)
        SELECT page_id, regexp_matches(url,'^https?://') AS url_safe, regexp_matches(tail,'^(https?://|mailto:|/|#)') AS tail_safe FROM t""",
    "scan_pages": f"""SELECT 'node' AS kind, unnest(['script','style','comment']) AS reason, unnest([a, b, c]) AS n FROM (
        SELECT sum({_n('<script')})::BIGINT AS a, sum({_n('<style')})::BIGINT AS b, sum({_n('<!--')})::BIGINT AS c FROM pages)""",
    "sanitize_strict_parts": STRICT,
    "sanitize_permissive_parts": _part_markup("", "''", "", "", CARD, "", ""),
    "sanitize_minimum_parts": _part_markup("", f"'<script>s</script>' || {COMMENT}", "", "", CARD, "", ""),
    "sanitize_custom_parts": _part_markup("", COMMENT, "", "", CARD, "", ""),
    "sanitize_none_parts": _part_markup(
        ' onclick="x()"', f"'<script>s</script>' || {COMMENT}", ' href="javascript:1"', ' style="x"',
        "'<x-card size=\"1\" onload=\"y\">' || p_type || '</x-card>'", ' onload="q"', "<animate></animate>"),
    "sanitize_snippets": STRICT,
    "sanitized_text": f"SELECT page_id, {_txt(NOTAGS.format(CODE))} AS text FROM pages",
    "sanitized_counts": f"""SELECT page_id, 0::BIGINT AS n_code, 0::BIGINT AS n_comments, {_n('<a href')} AS n_links,
        {_n('<p>')} AS n_paragraphs FROM pages""",
    "set_nofollow": _nav(_ser(f"regexp_replace({NAV},'<a href=\"([^\"]*)\">','<a href=\"\\1\" rel=\"nofollow\">','g')")),
    "remove_hrefs": _nav(_ser(f"regexp_replace({NAV},' href=\"[^\"]*\"','','g')")),
    "set_from_table": _nav(f"replace({NAV_OUT}, '\">', '\" data-from=\"' || replace(url,'&','&amp;') || '\">')"),
    "add_class_ads": "SELECT page_id, '<div class=\"ad seen\">' || "
        + _ser("regexp_extract(html,'(?s)<div class=\"ad\">(.*?)</div>',1)") + " || '</div>' AS outer_html FROM pages",
    "class_edits": """SELECT p_partkey AS page_id, '<p class="b">' || p_name
        || '</p><p class="a b c">x</p><p class="d b">y</p><p class="">z</p>' AS inner_html FROM part""",
    "insert_banner": """SELECT page_id, '<aside class="banner">' || page_id || '<br>!</aside>' AS outer_html, 2::BIGINT AS elem_idx FROM pages""",
    "insert_items": _nav(f"""replace(replace({NAV_OUT},'<ul>','<ul><li>first</li>'),'</ul>','<li class="end"></li><!-- c --></ul>t&lt;')"""),
    "insert_nested_siblings": _nav(f"replace({NAV_OUT},'<li>','<hr><li>')"),
    "remove_ads": f"SELECT page_id, 0::BIGINT AS n_div, {_n('<li>')} - 1 AS n_li, true AS dense FROM pages",
    "set_inner_html": _nav("'<nav><b>page ' || page_id || '<i>x</i></b></nav>'"),
    "set_inner_html_safe": _nav("'<nav><p id=\"p' || page_id || '\">ok ' || page_id || '</p></nav>'"),
    "edit_log": ITEMS + f"""SELECT page_id, '<nav><ul>' || string_agg('<li id="p' || page_id || '">new ' || length(url) || '</li><!--second--><li><a href="' || href || '">'
        || CASE i WHEN 1 THEN '<b>first</b>' ELSE {_ser('txt')} END || '</a></li>', '' ORDER BY i) || '</ul>later<p>end</p></nav>' AS outer_html
        FROM items WHERE i % 2 = 1 GROUP BY page_id""",
    "import_subtree": f"""WITH n AS (SELECT page_id, {NAV_OUT} AS nav FROM pages)
        SELECT n.page_id, replace(n.nav, '<ul>', '<ul>' || coalesce(regexp_extract(b.nav, '(?s)(<li>.*?</li>)', 1), '')) AS outer_html
        FROM n LEFT JOIN n b ON b.page_id = n.page_id - 1""",
    "insert_parsed": "SELECT p_partkey AS page_id, '<p><b>' || p_partkey || '<i></i></b>' || p_name || '</p>' AS inner_html FROM part",
    "set_text": _nav(f"regexp_replace({NAV_OUT},'(?s)<li>.*?</li>','<li>a &lt; b</li>')"),
    "replace_children": _nav("'<nav><ul><li id=\"0\"></li></ul></nav>'"),
    "replace_text": "SELECT page_id, 'Page ' || page_id AS text_content, 'not a text node' AS error FROM pages",
    "copy_subtree": _nav(f"replace({NAV_OUT},'</ul>', regexp_extract({NAV_OUT},'(?s)(<li>.*?</li>)',1) || '</ul>')"),
    "clear_document": "SELECT page_id, regexp_extract(html,'(<html[^>]*>)',1) || '<head></head><body></body></html>' AS html FROM pages",
    "part_template_use": """SELECT p_partkey AS page_id, '<ul id="u" class="list"><li>' || p_name || '</li><li>' || p_type || '</li><li>'
        || p_brand || '</li><li>' || p_brand || '</li></ul><template><li>' || p_brand || '</li></template>' AS inner_html FROM part""",
    "template_html": "SELECT p_partkey AS page_id, '<li>' || p_brand || '</li>' AS template_html FROM part",
    "template_content": "SELECT unnest(['element','text']) AS node_type, unnest([k, k]) AS n, unnest([k, 0]) AS n_top FROM (SELECT count(*) AS k FROM part)",
    "parse_and_append": """SELECT p_partkey AS page_id, '<ul id="u" class="list"><li>' || p_name || '</li><li>' || p_type
        || '</li><li>T</li> <li>z</li></ul>' AS outer_html FROM part""",
    "append_fragment": """SELECT p_partkey AS page_id, '<table><tbody><tr><td>' || p_partkey || '</td></tr><tr><td>2</td></tr></tbody></table>'
        || p_name AS inner_html FROM part""",
    "render_orders": """SELECT o_orderkey, '<tr id="' || o_orderkey || '"><td>' || o_orderpriority || '</td><td>' || o_orderstatus
        || '</td><td>{missing}</td></tr>' AS html FROM orders""",
    "render_documents": """SELECT doc_id, '<article lang="' || lang || '">' || replace(replace(replace(replace(replace(text,'&','&amp;'),
        '<','&lt;'),'>','&gt;'),'"','&quot;'),'''','&#39;') || '</article>' AS html FROM documents""",
    "render_raw": "SELECT p_partkey, '<p>' || p_type || '</p>' AS html FROM part",
    "render_nations": """SELECT n_regionkey, count(*) AS n_rows,
        '<ul>' || string_agg('<li>' || n_name || '</li>', '' ORDER BY n_nationkey) || '</ul>' AS html FROM nation GROUP BY 1""",
    "render_paged": """WITH r AS (SELECT o_orderstatus, o_orderkey,
          (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 100 AS page_no FROM orders)
        SELECT o_orderstatus, page_no, count(*) AS n_rows, string_agg('<li>' || o_orderkey || '</li>', '' ORDER BY o_orderkey) AS html
        FROM r GROUP BY 1, 2""",
    "reassemble_batch": "SELECT page_id, html, ceil(length(html) / 300)::BIGINT AS n_chunks FROM pages",
    "reassemble_stream": """SELECT page_id, CASE WHEN page_id % 10 <> 3 THEN html END AS html, ceil(length(html) / 300)::BIGINT + CASE WHEN page_id % 10 = 3 THEN 1 ELSE 2 END AS n_rows,
        CASE WHEN page_id % 10 = 3 THEN 'abandoned before end' END AS error FROM pages""",
    "render_parts": """WITH r AS (SELECT l_returnflag, l_orderkey || '.' || l_linenumber || ';' AS s, l_orderkey, l_linenumber, (row_number() OVER w - 1) // 10000 AS page_no,
            (count(*) OVER (PARTITION BY l_returnflag) - 1) // 10000 AS final FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber))
        SELECT l_returnflag, page_no, count(*) AS n_rows, md5(CASE WHEN page_no = 0 THEN '[' ELSE '' END || string_agg(s, '' ORDER BY l_orderkey, l_linenumber)
            || CASE WHEN page_no = final THEN ']' ELSE '' END) AS html_md5 FROM r GROUP BY l_returnflag, page_no, final""",
    "protocol_errors": """WITH c AS (SELECT conv_id AS page_id, CASE WHEN turn IN (0, 4) THEN 'begin' WHEN turn = 3 THEN 'end' ELSE 'chunk' END AS kind,
          CASE WHEN turn >= 5 THEN turn + 1 ELSE turn END AS seq FROM conversations),
        m AS (SELECT *, coalesce(lag(seq) OVER w, -1) AS prev, coalesce(last_value(CASE WHEN kind <> 'chunk' THEN kind END IGNORE NULLS)
            OVER (PARTITION BY page_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 'begin', false) AS opened
          FROM c WINDOW w AS (PARTITION BY page_id ORDER BY seq))
        SELECT page_id, seq, kind, 'chunk before begin' AS error FROM m WHERE kind = 'chunk' AND NOT opened
        UNION ALL SELECT page_id, seq, kind, 'begin twice' FROM m WHERE kind = 'begin' AND opened
        UNION ALL SELECT page_id, seq, kind, 'end without begin' FROM m WHERE kind = 'end' AND NOT opened
        UNION ALL SELECT page_id, seq, kind, 'missing seq' FROM m WHERE seq - prev > 1""",
}
