"""Per-page stack machine that turns one page's tokens into numbered tree nodes.

Spark tokenises, distributes and post-processes; this helper only decides parents, which the
HTML rules define as a sequential stack walk and no relational operator can express.
"""

from __future__ import annotations

import html
import re

# --- fixed values: element classes of the HTML tree construction rules -------------------------
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer header hgroup main menu nav ol p search section summary ul listing pre".split())
CLOSES_P = BLOCKS | HEADINGS | frozenset("form hr table xmp plaintext".split())
BLOCK_ENDS = (BLOCKS | frozenset(["button"])) - {"p"}
MARKED = frozenset("applet marquee object".split())
IMPLIED = frozenset("dd dt li optgroup option p rb rp rt rtc".split())
TABLE_PARTS = frozenset("caption col colgroup tbody td tfoot th thead tr".split())
SECTIONS = frozenset("tbody tfoot thead".split())
FOSTERED = SECTIONS | {"table", "tr"}
CONTEXTS = FOSTERED | {"td", "th", "caption", "colgroup", "template", "html"}
POINTS = frozenset("foreignObject desc title mi mo mn ms mtext annotation-xml".split())
SCOPE = frozenset("applet caption html table td th marquee object template".split()) | POINTS
BUTTON_SCOPE, LIST_SCOPE = SCOPE | {"button"}, SCOPE | {"ol", "ul"}
TABLE_SCOPE = frozenset("html table template".split())
SPECIAL = (BLOCKS | HEADINGS | HEAD | TABLE_PARTS | MARKED | POINTS | VOID) - {"dialog"} | frozenset(
    "body button dd dt form frame frameset head html iframe li select table textarea xmp "
    "plaintext noembed keygen".split())
BREAKOUT = HEADINGS | frozenset(
    "b big blockquote body br center code dd div dl dt em embed head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
SVG_CASE = {n.lower(): n for n in (
    "altGlyph altGlyphDef altGlyphItem animateColor animateMotion animateTransform clipPath feBlend "
    "feColorMatrix feComponentTransfer feComposite feConvolveMatrix feDiffuseLighting "
    "feDisplacementMap feDistantLight feDropShadow feFlood feFuncA feFuncB feFuncG feFuncR "
    "feGaussianBlur feImage feMerge feMergeNode feMorphology feOffset fePointLight "
    "feSpecularLighting feSpotLight feTile feTurbulence foreignObject glyphRef linearGradient "
    "radialGradient textPath "
    "attributeName attributeType baseFrequency baseProfile calcMode clipPathUnits diffuseConstant "
    "edgeMode filterUnits gradientTransform gradientUnits kernelMatrix kernelUnitLength keyPoints "
    "keySplines keyTimes lengthAdjust limitingConeAngle markerHeight markerUnits markerWidth "
    "maskContentUnits maskUnits numOctaves pathLength patternContentUnits patternTransform "
    "patternUnits pointsAtX pointsAtY pointsAtZ preserveAlpha preserveAspectRatio primitiveUnits "
    "refX refY repeatCount repeatDur requiredExtensions requiredFeatures specularConstant "
    "specularExponent spreadMethod startOffset stdDeviation stitchTiles surfaceScale "
    "systemLanguage tableValues targetX targetY textLength viewBox viewTarget xChannelSelector "
    "yChannelSelector zoomAndPan").split()}
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
KEEP_WS = frozenset("pre textarea script style code".split())
RAW_TEXT = frozenset("style script xmp iframe noembed noframes plaintext".split())
# -----------------------------------------------------------------------------------------------

WS = " \t\n\r\f"
ATTR_RX = re.compile(r"""([^\s/>"'=][^\s/>=]*|=[^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?""")
NAME_RX = re.compile(r"</?([a-zA-Z][^\s/>]*)")
OPEN_RX = re.compile(r"""<[^\s/>]+(?:[^>="']+|=\s*"[^"]*"|=\s*'[^']*'|[="'])*>""")
ELEMENT, TEXT, COMMENT, DOCTYPE = "element", "text", "comment", "doctype"


def lex_tag(raw):
    """(name, attributes, self-closing) of one start or end tag."""
    m = NAME_RX.match(raw)
    stop = -2 if raw.endswith("/>") else -1
    attrs, seen = [], set()
    for a in ATTR_RX.finditer(raw, m.end(), max(m.end(), len(raw) + stop)):
        name = a.group(1).lower()
        if name not in seen:
            seen.add(name)
            value = next((v for v in a.group(2, 3, 4) if v is not None), None)
            attrs.append((name, html.unescape(value) if value and "&" in value else value))
    return m.group(1).lower(), attrs, stop == -2


class Node:
    __slots__ = ("kind", "tag", "ns", "text", "attrs", "parent", "kids", "place", "pre", "last")

    def __init__(self, kind, tag=None, text=None, attrs=None, ns=""):
        self.kind, self.tag, self.ns, self.text = kind, tag, ns, text
        self.attrs, self.parent, self.kids = attrs or [], None, []


class TreeBuilder:
    def __init__(self, fragment=False):
        self.document = Node("document")
        self.stack, self.fmt, self.open, self.live = [], [], {}, set()
        self.fragment, self.foster, self.skip_newline = fragment, False, False
        self.form = self.head = self.body = None
        self.phase = 3 if fragment else 0   # 0 before head, 1 head, 2 after head, 3 body, 4-5 after
        if fragment:
            self.body_root = Node(ELEMENT, "template")
            self.push(self.body_root)

    # -- nodes, stack, insertion point ----------------------------------------------------------
    def push(self, n):
        self.stack.append(n)
        self.live.add(n)
        self.open[n.tag] = self.open.get(n.tag, 0) + 1

    def drop(self, i=-1):
        n = self.stack.pop(i)
        self.live.discard(n)
        self.open[n.tag] -= 1
        return n

    def spot(self, target=None):
        """(parent, following sibling or None) where the next node goes."""
        target = self.stack[-1] if target is None else target
        if self.foster and target.tag in FOSTERED:
            for i in range(len(self.stack) - 1, -1, -1):
                n = self.stack[i]
                if n.tag == "template":
                    return n, None
                if n.tag == "table":
                    return (self.stack[i - 1], None) if n.parent is None else (n.parent, n)
        return target, None

    def place(self, n, spot):
        old, (parent, before) = n.parent, spot
        if old is not None:
            old.kids.remove(n)
        n.parent = parent
        kids = parent.kids
        if before is None:
            kids.append(n)
        else:
            kids.insert(self.where(kids, before), n)

    @staticmethod
    def where(kids, before):
        return len(kids) - 1 if kids[-1] is before else kids.index(before)

    def insert(self, tag, attrs=None, ns="", leaf=False):
        n = Node(ELEMENT, tag, None, attrs, ns)
        self.place(n, self.spot())
        if not leaf:
            self.push(n)
        return n

    def add_text(self, s):
        if not s:
            return
        parent, before = self.spot()
        kids = parent.kids
        at = len(kids) if before is None else self.where(kids, before)
        if at and kids[at - 1].kind == TEXT:
            kids[at - 1].text += s
        else:
            self.place(Node(TEXT, None, s), (parent, before))

    # -- scopes and implied ends ------------------------------------------------------------------
    def in_scope(self, names, scope=SCOPE):
        if not any(self.open.get(n) for n in names):
            return False
        for n in reversed(self.stack):
            if n.tag in names and not n.ns:
                return True
            if n.tag in scope:
                return False
        return False

    def implied(self, but=None):
        while self.stack[-1].tag in IMPLIED and self.stack[-1].tag != but:
            self.drop()

    def pop_to(self, names, keep=False):
        while len(self.stack) > 1 and self.stack[-1].tag not in names:
            self.drop()
        if not keep and len(self.stack) > 1:
            self.drop()

    def close(self, name, scope=SCOPE):
        if self.in_scope((name,), scope):
            self.implied(name)
            self.pop_to((name,))
            return True
        return False

    def close_item(self, names):
        for n in reversed(self.stack):
            t = n.tag
            if t in names:
                self.implied(t)
                return self.pop_to((t,))
            if t in SPECIAL and t not in ("address", "div", "p"):
                return None

    def context(self):
        return next((n.tag for n in reversed(self.stack) if n.tag in CONTEXTS), None)

    # -- active formatting elements ---------------------------------------------------------------
    def clear_marker(self):
        while self.fmt and self.fmt.pop() is not None:
            pass

    def clone(self, n):
        return Node(ELEMENT, n.tag, None, list(n.attrs), n.ns)

    def reconstruct(self):
        fmt, i = self.fmt, len(self.fmt)
        if not fmt or fmt[-1] is None or fmt[-1] in self.live:
            return
        while i and fmt[i - 1] is not None and fmt[i - 1] not in self.live:
            i -= 1
        for j in range(i, len(fmt)):
            fmt[j] = self.insert(fmt[j].tag, list(fmt[j].attrs))

    def push_format(self, n):
        twins = []
        for m in reversed(self.fmt):
            if m is None:
                break
            if m.tag == n.tag and sorted(m.attrs, key=str) == sorted(n.attrs, key=str):
                twins.append(m)
        if len(twins) >= 3:
            self.fmt.remove(twins[2])
        self.fmt.append(n)

    def find_format(self, name):
        for n in reversed(self.fmt):
            if n is None or n.tag == name:
                return n
        return None

    def adopt(self, name):
        """Misnested formatting: split the formatting element around the furthest block."""
        stack, fmt = self.stack, self.fmt
        if stack[-1].tag == name and stack[-1] not in fmt:
            self.drop()
            return
        for _ in range(8):
            f = self.find_format(name)
            if f is None:
                return self.end_other(name)
            if f not in self.live:
                fmt.remove(f)
                return
            if not self.in_scope((name,)):
                return
            at = stack.index(f)
            block = next((n for n in stack[at + 1:] if n.tag in SPECIAL), None)
            if block is None:
                while self.drop() != f:
                    pass
                fmt.remove(f)
                return
            mark, moved, i, rounds = fmt.index(f), block, stack.index(block), 0
            while stack[i - 1] != f:
                i, rounds = i - 1, rounds + 1
                n = stack[i]
                if n in fmt and rounds > 3:
                    mark -= fmt.index(n) < mark
                    fmt.remove(n)
                if n not in fmt:
                    self.drop(i)
                    continue
                copy = self.clone(n)
                fmt[fmt.index(n)] = stack[i] = copy
                self.live.discard(n)
                self.live.add(copy)
                if moved == block:
                    mark = fmt.index(copy) + 1
                self.place(moved, (copy, None))
                moved = copy
            self.place(moved, self.spot(stack[at - 1]))
            copy = self.clone(f)
            for k in list(block.kids):
                self.place(k, (copy, None))
            self.place(copy, (block, None))
            mark -= fmt.index(f) < mark
            fmt.remove(f)
            fmt.insert(mark, copy)
            stack.remove(f)
            stack.insert(stack.index(block) + 1, copy)
            self.live.discard(f)
            self.live.add(copy)

    # -- document phases --------------------------------------------------------------------------
    def enter(self, phase, attrs=None):
        """Create the implied html / head / body up to ``phase``."""
        if not self.stack:
            n = Node(ELEMENT, "html")
            self.place(n, (self.document, None))
            self.push(n)
        if self.phase == 0 and phase >= 1:
            self.head = self.insert("head")
            self.phase = 1
        if self.phase == 1 and phase >= 2:
            self.pop_to(("html",), keep=True)
            self.phase = 2
        if self.phase == 2 and phase >= 3:
            self.body = self.insert("body", attrs)
            self.phase = 3

    def merge(self, n, attrs):
        have = {a for a, _ in n.attrs}
        n.attrs.extend(a for a in attrs if a[0] not in have)

    def early_start(self, name, attrs):
        """True when the tag was consumed (or redirected into head) before body starts."""
        self.enter(0)
        if name == "html":
            self.merge(self.stack[0], attrs)
            return True
        if name == "head":
            if self.phase == 0:
                self.enter(1)
                self.head.attrs = attrs
            return True
        if name in HEAD:
            self.enter(1)
            if self.phase == 2:
                self.push(self.head)
            return False
        self.enter(2)
        self.enter(3, attrs if name == "body" else None)
        return name == "body"

    # -- token handlers -----------------------------------------------------------------------------
    def start(self, name, attrs, selfclosed=False, raw=None):
        if self.phase >= 4:
            self.phase = 3
        if self.phase < 3 and not self.open.get("template") and self.early_start(name, attrs):
            return
        late_head = self.phase == 2 and not self.open.get("template")
        cur = self.stack[-1]
        if cur.ns and not (cur.tag in POINTS and name not in ("mglyph", "malignmark")):
            if name not in BREAKOUT and not (name == "font" and {"color", "face", "size"} & {a for a, _ in attrs}):
                return self.foreign(name, attrs, cur.ns, selfclosed, raw)
            while self.stack[-1].ns and self.stack[-1].tag not in POINTS:
                self.drop()
        self.foster = False
        if self.open.get("select") and self.in_scope(("select",), TABLE_SCOPE) and not self.select_start(name):
            return
        if name in TABLE_PARTS:
            return self.table_start(name, attrs)
        if (self.open.get("table") or self.open.get("template")) and self.context() in FOSTERED | {"colgroup"}:
            if self.context() == "colgroup" and name != "template":
                self.pop_to(("colgroup",))
            if name == "table":
                self.pop_to(("table",))
            elif name == "form":
                if self.form is None and not self.open.get("template"):
                    self.form = self.insert(name, attrs, leaf=True)
                return
            else:
                hidden = name == "input" and any(a == "type" and (v or "").lower() == "hidden" for a, v in attrs)
                self.foster = not hidden and name not in ("style", "script", "template")
        self.body_start(name, attrs, selfclosed, raw)
        self.foster = False
        if late_head and name != "template" and self.head in self.stack:
            self.drop(self.stack.index(self.head))

    def body_start(self, name, attrs, selfclosed, raw):
        if name in ("html", "body"):
            if not self.open.get("template"):
                self.merge(self.stack[0] if name == "html" else self.body, attrs)
            return
        if name in ("head", "frame", "frameset"):
            return
        if name in CLOSES_P:
            if name == "form" and self.form is not None and not self.open.get("template"):
                return
            if self.open.get("p"):
                self.close("p", BUTTON_SCOPE)
            if name in HEADINGS and self.stack[-1].tag in HEADINGS:
                self.drop()
            n = self.insert(name, attrs, leaf=name == "hr")
            if name == "form" and not self.open.get("template"):
                self.form = n
            self.skip_newline = name in ("pre", "listing")
        elif name in ("li", "dd", "dt"):
            self.close_item(("li",) if name == "li" else ("dd", "dt"))
            self.close("p", BUTTON_SCOPE)
            self.insert(name, attrs)
        elif name in FORMATTING:
            if name in ("a", "nobr"):
                old = self.find_format(name)
                if old is not None:
                    self.adopt(name)
                    if old in self.fmt:
                        self.fmt.remove(old)
                    if old in self.live:
                        self.drop(self.stack.index(old))
            self.reconstruct()
            self.push_format(self.insert(name, attrs))
        elif name in HEAD and name != "noscript":
            self.insert(name, attrs, leaf=name in VOID)
            if name == "template":
                self.fmt.append(None)
        elif name in VOID or name in ("image", "keygen"):
            if name not in ("param", "source", "track"):
                self.reconstruct()
            self.insert("img" if name == "image" else name, attrs, leaf=True)
        elif name in ("svg", "math"):
            self.reconstruct()
            self.foreign(name, attrs, name, selfclosed, raw)
            return
        else:
            if name == "button":
                self.close("button")
            elif name in ("option", "optgroup") and self.stack[-1].tag == "option":
                self.drop()
            elif name in ("rb", "rp", "rt", "rtc") and self.in_scope(("ruby",)):
                self.implied("rtc" if name in ("rp", "rt") else None)
            if name not in ("textarea", "iframe", "noembed", "rb", "rp", "rt", "rtc"):
                self.reconstruct()
            self.insert(name, attrs)
            if name in MARKED:
                self.fmt.append(None)
        if name in RAW:
            self.add_raw(name, raw)

    def add_raw(self, name, raw):
        self.foster = False
        if raw and name == "textarea" and raw[0] == "\n":
            raw = raw[1:]
        self.add_text(html.unescape(raw) if raw and name in ("textarea", "title") else raw)
        self.drop()

    def foreign(self, name, attrs, ns, selfclosed, raw):
        if ns == "svg":
            name = SVG_CASE.get(name, name)
            attrs = [(SVG_CASE.get(a, a), v) for a, v in attrs]
        self.insert(name, attrs, ns, leaf=selfclosed)
        if raw is not None and not selfclosed:
            self.add_raw("title", raw)

    def select_start(self, name):
        """False when the tag is ignored inside select; may close the select first."""
        top = self.stack[-1].tag
        if name in ("option", "optgroup", "hr"):
            if top == "option":
                self.drop()
            if name != "option" and self.stack[-1].tag == "optgroup":
                self.drop()
            return True
        if name in ("script", "template"):
            return True
        if name in ("select", "input", "keygen", "textarea") or (
                (name in TABLE_PARTS or name == "table") and self.open.get("table")):
            self.pop_to(("select",))
            return name != "select"
        return False

    def table_start(self, name, attrs):
        while True:
            ctx = self.context()
            if ctx == "template":
                if self.stack[-1].tag == "template":
                    self.insert(name, attrs, leaf=name == "col")
                    if name in ("td", "th", "caption"):
                        self.fmt.append(None)
                return
            if ctx in (None, "html"):
                return
            if ctx in ("td", "th", "caption"):
                self.implied()
                self.pop_to((ctx,))
                self.clear_marker()
            elif ctx == "colgroup":
                if name == "col":
                    self.insert(name, attrs, leaf=True)
                    return
                self.pop_to(("colgroup",))
            elif ctx == "tr":
                self.pop_to(("tr",), keep=True)
                if name in ("td", "th"):
                    self.insert(name, attrs)
                    self.fmt.append(None)
                    return
                self.drop()
            elif ctx in SECTIONS:
                self.pop_to(SECTIONS, keep=True)
                if name in ("tr", "td", "th"):
                    self.insert("tr", attrs if name == "tr" else None)
                    if name == "tr":
                        return
                else:
                    self.drop()
            else:
                self.pop_to(("table",), keep=True)
                implied = {"col": "colgroup", "tr": "tbody", "td": "tbody", "th": "tbody"}.get(name)
                self.insert(implied or name, None if implied else attrs)
                if implied is None:
                    if name == "caption":
                        self.fmt.append(None)
                    return

    def table_end(self, name):
        if name in ("col", "colgroup"):
            if self.stack[-1].tag == name:
                self.drop()
        elif self.in_scope((name,), TABLE_SCOPE):
            self.implied()
            self.pop_to((name,))
            if name in ("td", "th", "caption"):
                self.clear_marker()

    def end(self, name):
        if self.phase < 3 and not self.open.get("template"):
            if name == "head":
                self.enter(2)
            elif name == "noscript" and self.stack[-1].tag == "noscript":
                self.drop()
            if name not in ("body", "html", "br"):
                return
            self.enter(3)
        if name in ("body", "html"):
            if self.body is not None and not self.open.get("template"):
                self.phase = 5 if name == "html" else 4
            return
        if self.phase >= 4:
            self.phase = 3
        if self.stack[-1].ns:
            for n in reversed(self.stack):
                if not n.ns:
                    break
                if n.tag.lower() == name:
                    while self.drop() != n:
                        pass
                    return
        context = self.context() if self.open.get("table") else None
        self.foster = context in FOSTERED
        if name == "table" or name in TABLE_PARTS:
            self.table_end(name)
        elif name == "template":
            if self.open.get("template", 0) > self.fragment:
                self.pop_to(("template",))
                self.clear_marker()
                if self.phase == 2 and self.head in self.stack:
                    self.drop(self.stack.index(self.head))
        elif name == "p":
            if not self.in_scope(("p",), BUTTON_SCOPE):
                self.insert("p")
            self.close("p", BUTTON_SCOPE)
        elif name in FORMATTING:
            self.adopt(name)
        elif name == "li":
            self.close("li", LIST_SCOPE)
        elif name in HEADINGS:
            if self.in_scope(HEADINGS):
                self.implied()
                self.pop_to(HEADINGS)
        elif name == "form" and not self.open.get("template"):
            n, self.form = self.form, None
            if n in self.stack and self.in_scope(("form",)):
                self.implied()
                self.drop(self.stack.index(n))
        elif name in BLOCK_ENDS or name in ("dd", "dt", "form", "select"):
            self.close(name)
        elif name in MARKED:
            if self.close(name):
                self.clear_marker()
        elif name == "br":
            self.reconstruct()
            self.insert("br", leaf=True)
        else:
            self.end_other(name)
        self.foster = False

    def end_other(self, name):
        for n in reversed(self.stack[1:]):
            if n.tag == name and not n.ns:
                self.implied(name)
                while self.drop() != n:
                    pass
                return
            if n.tag in SPECIAL:
                return

    def chars(self, s):
        if self.phase < 3 and not self.open.get("template"):
            rest = s.lstrip(WS)
            lead = s[:len(s) - len(rest)]
            if lead and self.phase in (1, 2):
                self.add_text(lead)
            if not rest:
                return
            self.enter(3)
            s = rest
        blank = not s.strip(WS)
        if self.phase >= 4 and not blank:
            self.phase = 3
        top = self.stack[-1].tag
        if self.stack[-1].ns or (self.open.get("select") and top in ("select", "option", "optgroup")):
            return self.add_text(s)
        if top == "colgroup" and not blank:
            self.drop()
            top = self.stack[-1].tag
        if top in FOSTERED or top == "colgroup":
            if blank:
                return self.add_text(s)
            self.foster = True
        self.reconstruct()
        self.add_text(s)
        self.foster = False

    def comment(self, s):
        at = (self.document, None) if not self.stack or self.phase == 5 else \
            (self.stack[0], None) if self.phase == 4 else self.spot()
        self.place(Node(COMMENT, None, s), at)

    def feed(self, raw, memo):
        skip, self.skip_newline = self.skip_newline, False
        if raw[0] != "<" or len(raw) == 1:
            s = html.unescape(raw) if "&" in raw else raw
            if "\r" in s or "\0" in s:
                s = s.replace("\r\n", "\n").replace("\r", "\n").replace("\0", "")
            return self.chars(s[1:] if skip and s[:1] == "\n" else s)
        hit = memo.get(raw)
        if hit is None:
            hit = memo[raw] = self.lex(raw)
        what, payload = hit
        if what == "start":
            name, attrs, selfclosed, body = payload
            self.start(name, list(attrs), selfclosed, body)
        elif what == "end":
            self.end(payload)
        elif what == "comment":
            self.comment(payload)
        elif what == "doctype" and not self.stack and not self.fragment:
            self.place(Node(DOCTYPE, None, payload), (self.document, None))

    @staticmethod
    def lex(raw):
        c = raw[1]
        if c == "!" or c == "?":
            if raw.startswith("<!--"):
                m = re.match(r"<!--(?:-?>|(.*?)(?:--!?>|\Z))", raw, re.S)
                return "comment", m.group(1) or ""
            if raw[2:9].lower() == "doctype":
                return "doctype", raw[9:].rstrip(">").strip()
            return "comment", raw[2 - (c == "?"):].removesuffix(">")
        if c == "/":
            if not raw[2:3].isascii() or not raw[2:3].isalpha():
                return ("comment", raw[2:-1]) if raw != "</>" else ("skip", None)
            return ("end", NAME_RX.match(raw).group(1).lower()) if raw.endswith(">") else ("skip", None)
        body, m = None, OPEN_RX.match(raw)
        if m is None:
            return "skip", None
        name = NAME_RX.match(raw).group(1).lower()
        if m.end() < len(raw) or name in RAW:
            at = raw.rfind("</")
            closed = at >= m.end() and re.match(name + r"[\s/>]", raw[at + 2:], re.I)
            body = raw[m.end():at] if closed else raw[m.end():]
        return "start", (*lex_tag(m.group()), body)

    # -- numbering ------------------------------------------------------------------------------------
    def rows(self):
        """Pre-order rows of the finished tree, in KERNEL_NODE field order."""
        if not self.fragment:
            self.enter(3)
        order, todo = [], []
        # parent, tree, owner, depth, in svg, whitespace kept, in body, raw text below
        top = self.body_root if self.fragment else self.document
        self.family(top, (None, 0, None, 0, False, False, self.fragment, False), todo)
        while todo:
            n, _, (_, tree, owner, depth, svg, keep, inside, _) = entry = todo.pop()
            n.pre = pre = len(order)
            order.append(entry)
            if n.kids:
                tag, html_ns = n.tag, not n.ns
                link = (None, pre + 1, pre) if tag == "template" and html_ns else (pre, tree, owner)
                self.family(n, (*link, depth + 1, svg or n.ns == "svg", keep or tag in KEEP_WS,
                                inside or n is self.body, tag in RAW_TEXT and html_ns), todo)
        for n, _, _ in reversed(order):
            n.last = n.kids[-1].last if n.kids else n.pre
        out = []
        for n, idx, (up, tree, owner, depth, svg, keep, inside, raw) in order:
            if n.kind == ELEMENT:
                out.append((tree, n.pre, up, owner, n.pre, n.last, depth, *idx, ELEMENT, n.ns or "html", n.tag, None,
                            n.attrs, svg or n.ns == "svg", keep or n.tag in KEEP_WS, inside or n is self.body, False))
            else:
                out.append((tree, n.pre, up, owner, n.pre, n.last, depth, *idx, n.kind, None, None, n.text,
                            n.attrs, svg, keep, inside, raw and n.kind == TEXT))
        return out

    @staticmethod
    def family(parent, frame, todo):
        """Push a node's children in reverse, with sibling, element and same-type positions."""
        tags = [k.tag for k in parent.kids if k.kind == ELEMENT]
        e, left, totals = len(tags), {}, {}
        for t in tags:
            totals[t] = totals.get(t, 0) + 1
        for i in range(len(parent.kids), 0, -1):
            k = parent.kids[i - 1]
            if k.kind == ELEMENT:
                t = left[k.tag] = left.get(k.tag, totals[k.tag] + 1) - 1
                todo.append((k, (i, e, len(tags), t, totals[k.tag]), frame))
                e -= 1
            else:
                todo.append((k, (i, None, len(tags), None, None), frame))


def build_rows(tokens, fragment, memo):
    builder = TreeBuilder(fragment)
    if len(memo) > 20000:
        memo.clear()
    for raw in tokens:
        builder.feed(raw, memo)
    return builder.rows()
