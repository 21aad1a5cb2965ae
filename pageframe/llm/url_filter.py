"""URL filter: every glob rule in one bit-parallel automaton (Shift-And), run over whole columns of URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pageframe.llm.common import without

# Host and path rules, each for its host and all subdomains and for paths that start with it.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
# Globs for addresses without a rule: blocked if one fits, allowed otherwise.  `*` stands for a run without
# "/" and "?", `**` for any run; every other character for itself.
BLOCKED = ("*casino**", "*poker**", "*-bets.**", "*-pills.**", "*.ads-**", "*.adserver.**", "*.doubleclick.net**", "*spam-**",
           "*.adult-**", "*.xxx/**", "**/ads/**", "**/adclick**", "**/wp-admin/**", "**/wp-login**", "**/login",
           "**/login?**", "**/logout**", "**/cart/**", "**/checkout/**", "**/cgi-bin/**", "**/.git/**", "**.exe", "**.apk",
           "**.iso")


def rule_glob(host: str, path: str) -> str:
    """The glob of a host and path rule over canonical URLs: "." + host + path + query."""
    return f"*.{host}{path}**"


class Automaton:
    """All globs as one row of bits, 64 to a word.

    A glob of m literals takes m + 1 bits: its start and one per literal.  Reading a byte c turns the
    states D into ((D << 1) & B[c]) | (D & L[c]): B[c] has the literals equal to c, L[c] the states in
    which a wildcard may swallow c.  B never holds a start bit, so no glob runs on into the next one.
    """

    def __init__(self, globs):
        import numpy as np

        literals, start, final, any_run, segment_run = [], [], [], [], []
        for glob in globs:
            raw, at = glob.encode(), 0
            start.append(len(literals))
            literals.append(None)
            while at < len(raw):
                if raw[at:at + 2] == b"**":
                    any_run.append(len(literals) - 1)
                    at += 2
                elif raw[at:at + 1] == b"*":
                    segment_run.append(len(literals) - 1)
                    at += 1
                else:
                    literals.append(raw[at])
                    at += 1
            final.append(len(literals) - 1)
        self.words = len(literals) // 64 + 1
        self.final = final

        def mask(bits):
            out = np.zeros(self.words, dtype=np.uint64)
            for b in bits:
                out[b // 64] |= np.uint64(1) << np.uint64(b % 64)
            return out

        self.first = mask(start)
        self.reads = np.stack([mask([i for i, x in enumerate(literals) if x == c]) for c in range(256)])
        self.loops = np.stack([mask(any_run + segment_run * (chr(c) not in "/?")) for c in range(256)])

    def matches(self, data, offsets):
        """Boolean matrix, URLs by globs, for UTF-8 strings laid end to end in `data`."""
        import numpy as np

        length = np.diff(offsets)
        order = np.argsort(-length, kind="stable")           # longest first: the active rows are a prefix
        begin, length = offsets[:-1][order], length[order]
        state = np.repeat(self.first[None, :], len(order), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for t in range(int(length[0]) if len(length) else 0):
            active = int(np.searchsorted(-length, -t, side="left"))   # rows with length > t
            chars = data[begin[:active] + t]
            now = state[:active]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:active] = (moved & self.reads[chars]) | (now & self.loops[chars])
        out = np.empty((len(order), len(self.final)), dtype=bool)
        for k, bit in enumerate(self.final):
            out[order, k] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one == one
        return out


def host(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; empty for null or no "://"."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end; empty for null or no "://"."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules=RULES, blocked=BLOCKED) -> DataFrame:
    """All columns of `pages` and per row host, path, rule and verdict.

    The longest host and path rule that fits decides (equal lengths: the first in text order); `rule` is
    its text, else null.  Without one an address is blocked if a glob of `blocked` fits its canonical
    form, and otherwise allowed.  All patterns run at once in one automaton, on the rows where they
    are: no shuffle.  A null address or one without "://" has an empty host and path, fits no rule and is
    allowed.  Repeated rows give one row each; columns named like the new ones are replaced.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    globs = [rule_glob(h, p) for h, p, _ in ranked] + list(blocked)
    names = [h + p for h, p, _ in ranked]
    verdicts = [v for _, _, v in ranked] + ["block", "allow"]
    base = without(pages, "host", "path", "rule", "verdict", "_canonical", "_fit")
    url = F.col("url")
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)?", 1), F.lit(""))
    rows = base.withColumns({"host": host(url), "path": path(url)})

    automaton = Automaton(globs)

    @F.arrow_udf("int")
    def first_fit(canonical):
        import numpy as np
        import pyarrow as pa

        flat = canonical.cast(pa.large_string())
        offsets = np.frombuffer(flat.buffers()[1], dtype=np.int64)[flat.offset:flat.offset + len(flat) + 1]
        data = np.frombuffer(flat.buffers()[2] or b"", dtype=np.uint8)
        hit = automaton.matches(data, offsets)
        n = len(names)
        ruled, stopped = hit[:, :n], hit[:, n:].any(axis=1)
        return pa.array(np.where(ruled.any(axis=1), ruled.argmax(axis=1), np.where(stopped, n, n + 1)).astype(np.int32))

    canonical = F.concat(F.lit("."), F.col("host"), F.col("path"), query)
    fit = F.col("_fit")
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), fit + 1)
    return (rows.withColumn("_fit", first_fit(canonical))
            .withColumns({"rule": F.when(fit < len(names), pick(names + ["", ""])), "verdict": pick(verdicts)})
            .drop("_fit"))


def keep_allowed(pages: DataFrame, rules=RULES, blocked=BLOCKED) -> DataFrame:
    """The pages whose address is allowed, with their columns."""
    return judge(pages, rules, blocked).where(F.col("verdict") == "allow").select(*[F.col(f"`{c}`") for c in pages.columns])
