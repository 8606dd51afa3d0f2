"""Operator 9: main text of pages by inferred wrappers.

For each host the pages' token streams are turned into one union-free
regular expression (a wrapper: tags, text slots, optional and repeated
groups, no alternatives):

1. A page is cut into tokens: block tags with class and id, and texts; inline
   tags, comments, scripts and styles are no tokens. A token's path is that of
   its open elements.
2. A survey of the host counts for each path its pages, characters and
   different pages, and intersects the pages' sets of text digests (map-side
   first, so a host with a third of all pages costs a few rows). A text that
   every page with its path has is a fixed string, if the path has ``EVIDENCE``
   different pages and half of the host's pages, and stands in a region of its
   own: not inside a main element, and in a container without any varying text
   (a heading or line that an article has on every page is text of the
   article). But where the fixed strings outweigh the varying text, the pages
   are copies of each other and tell nothing, so there are none.
3. In a page's stream a fixed string keeps its digest and every other text is
   a slot. Side by side repeats of a group of tokens fold into one repeated
   group; equal folded streams of a host are counted once.
4. A host's streams are aligned one after the other, the most frequent
   first. Where wrapper and stream differ, the tokens on either side become
   optional groups; side by side repeats that this uncovers are folded again.
   A fixed string that does not align (the wrapper has it more often than any
   stream) has no fixed place and is a slot after all; the others are the
   template and no text of any page.
5. A slot is main text unless an element round it is a menu, header, footer or
   the like by tag or role, or by a word of its class or id. Against such a
   word the host's variation decides: a region with more varying text than all
   other slots is main text. If slots lie in an article (or main) element, only
   such slots count, unless the others have more varying text.
6. Inside a main element a word removes no heading, paragraph or the like, and
   a container only if more than half of its characters on the host are links
   and form controls, or if its class says nothing but advert, sidebar,
   pagination or comments (``FURNITURE``; also a section with id ``comments``).
   Of formulas the shown text is read, not the annotations.

The wrapper's verdict for each slot and string is joined back to the pages of
the host, and a page's text is read off the slots: character references
decoded, white space within a block made one space, blocks in page order
joined by one \\n.

The number of different streams of a host is bounded by the site's templates,
not by its pages; hosts with more than ``STREAMS`` are aligned in groups of
that many, whose wrappers are then united slot by slot.

Defined cases: a null or empty page gives an empty text and 0 characters; a
null url, or one without ``://``, belongs to the empty host; broken or cut off
markup is read as far as it goes; repeated rows give a row each; an empty
table gives no rows; extra columns are not returned.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import batch_column, keep
from starledger.llm.url_filter import host_path

STREAMS = 512  # streams of a host aligned in one go
PAGE = "/"  # in place of a path: the page as a whole
CONTROL = 20  # link characters that a form control counts as
EVIDENCE = 3  # different pages from which a host's variation counts
BROADCAST_BYTES = 32 << 20  # wrappers' slots are broadcast up to this measured size

# HTML's elements; fixed values of the standard.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
 form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul
 head title br""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg annotation annotation-xml textarea select button option canvas audio video xmp plaintext".split())
CONTROLS = frozenset("input textarea select button".split())
CLOSED_BY = {"p": BLOCK - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
             "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "head": {"body"}}
AWAY_TAGS = frozenset("head title nav header footer aside form fieldset dialog menu search".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
#: Words in class or id that mark what is not the article.
AWAY_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner popup modal
 overlay cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup login nav navbar
 navigation menu menus breadcrumb breadcrumbs sidebar aside rail widget widgets related recommended footer foot header masthead topbar
 toolbar share sharing social comment comments commentlist disqus replies reply respond discussion form search pagination pager
 copyright legal disclaimer skip toc""".split())
#: Classes that mark no text of an article even inside it, if nothing else but NEUTRAL words stands beside them.
FURNITURE = frozenset("ad ads advert adverts advertisement adsense sidebar navbar breadcrumb breadcrumbs pagination pager comments commentlist disqus".split())
NEUTRAL = frozenset("area list box block section wrap wrapper container inner outer item unit slot".split())
CONTAINERS = frozenset("div section ul ol dl table tbody tr details figure fieldset center dir hgroup".split())
TEXT_LEVEL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr caption blockquote pre figcaption summary address".split())
MAIN_TAGS, MAIN_ROLES = frozenset(("article", "main")), frozenset(("article", "main"))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_TAG_LIKE = re.compile(r"</?[a-zA-Z]")
_ATTR = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
_WORD = re.compile(r"[a-z]+")
_WITH = re.compile(r"\b(?:has|with|no|without)[-_ ]+[a-z]+")  # "has-sidebar" marks the page, not a sidebar
_ODD = re.compile(r"[^a-z0-9._-]+")


def _words(named: str) -> set[str]:
    return set(_WORD.findall(_WITH.sub(" ", re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower())))


def _label(name: str, attrs: str) -> str:
    """Tag with what tells its region: main (+), away (-), away by a word
    only (~), by a word that holds inside a main element too (^), or neither."""
    if not attrs.strip(" /"):
        return name + ("-" if name in AWAY_TAGS else "+" if name in MAIN_TAGS else "")
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}
    named = f"{found.get('class', '')} {found.get('id', '')}".strip()
    words, role = _words(named), found.get("role", "").lower()
    away = name in AWAY_TAGS or role in AWAY_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
    worded = words & AWAY_WORDS and name not in ("body", "html", *MAIN_TAGS)
    main = name in MAIN_TAGS or role in MAIN_ROLES or found.get("itemprop") == "articleBody"
    classes = _words(found.get("class", ""))
    furniture = name in CONTAINERS and classes & FURNITURE and classes <= FURNITURE | NEUTRAL or name == "section" and found.get("id", "").lower() == "comments"
    mark = "-" if away else "^" if worded and furniture else "~" if worded else "+" if main else ""
    named = _ODD.sub("_", re.sub(r"[0-9]+", "0", ".".join(named.lower().split())))
    return f"{name}.{named}={mark}" if named else name + mark


def read_page(page: str) -> list[tuple[str, str, int]]:
    """The page's tokens in order: (path, text, characters of it in links). A
    text slot's path is that of its open block elements; block boundaries and
    form controls have an empty text."""
    out: list[tuple[str, str, int]] = []
    stack: list[tuple[str, str]] = []  # (name, label)
    text: list[str] = []
    path, linked, depth = "", 0, -1  # depth: open blocks round the open link

    def flush():
        nonlocal linked
        if text:
            block = " ".join("".join(text).split())
            text.clear()
            if block:
                out.append((path, block, min(linked, len(block))))
        linked = 0

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            text.append(html_lib.unescape(page[at:]))
            break
        if lt > at:
            text.append(html_lib.unescape(page[at:lt]))
            if depth >= 0:
                linked += len(text[-1])
        m = _TOKEN.match(page, lt)
        if m is None:
            if _TAG_LIKE.match(page, lt):  # a tag with an open quote: it ends at the next ">"
                gt = page.find(">", lt)
                at = end if gt < 0 else gt + 1
            else:  # a lone "<" is text
                text.append("<")
                at = lt + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name == "a":
            depth = -1 if m[1] else len(stack)
        elif name in CONTROLS and not m[1]:
            out.append((path, "", CONTROL))
        if name in RAW and not m[1]:
            if not m[3].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if name not in BLOCK:
            continue
        if name == "br":  # white space within its block
            text.append(" ")
            continue
        flush()
        if m[1]:
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
        elif name not in VOID:
            while stack and name in CLOSED_BY.get(stack[-1][0], ()):
                stack.pop()
            stack.append((name, _label(name, m[3])))
        path = "/".join(label for _, label in stack)
        if len(stack) < depth:  # the block of an open link has ended
            depth = -1
        if m[1] is not None and name not in VOID:
            out.append((path, "", 0))
    flush()
    return out


def fold(tokens: list[str]) -> list[str]:
    """Side by side repeats of a group of tokens made one repeated group,
    marked by ``(`` and ``)+``; shorter groups first, until none is left."""
    changed = True
    while changed:
        changed = False
        for size in range(1, min(12, len(tokens) // 2) + 1):
            out, i = [], 0
            while i < len(tokens):
                group = tokens[i:i + size]
                if len(group) == size and tokens[i + size:i + 2 * size] == group:
                    while tokens[i + size:i + 2 * size] == group:
                        i += size
                    inner = group if size > 1 or not group[0].endswith(")+") else [group[0]]
                    out.append("(" + "\t".join(inner) + ")+" if size > 1 or not group[0].endswith(")+") else group[0])
                    i += size
                    changed = True
                else:
                    out.append(tokens[i])
                    i += 1
            tokens = out
    return tokens


def _digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


@lru_cache(maxsize=256)
def _lines(joined: str | None) -> frozenset[str]:
    return frozenset(joined.split("\n")) if joined else frozenset()


@lru_cache(maxsize=256)
def _string_paths(joined: str | None) -> frozenset[str]:
    return frozenset(s.rpartition("=")[0] for s in _lines(joined))


def string_of(path: str, text: str, strings: str | None) -> str | None:
    """The host's string (path, ``=``, digest) that a text is, if any."""
    if path in _string_paths(strings):
        found = f"{path}={_digest(text)}"
        if found in _lines(strings):
            return found
    return None


def stream(page: str, strings: str | None = None) -> str:
    """A page's folded token stream, one token a line."""
    return "\n".join(fold([(string_of(path, text, strings) or path + "#") if text else path for path, text, _ in read_page(page)]))


def _strings(tokens: list[str]) -> Counter:
    """How often each string stands in a list of tokens."""
    parts = (p.rstrip("?") for token in tokens for p in re.split(r"[\t()]", token))
    return Counter(p for p in parts if re.search(r"=[0-9a-f]{16}$", p))


def align(wrapper: list[str], other: list[str]) -> list[str]:
    """The wrapper that also takes ``other``: what either lacks is optional
    (``?``); a group that repeats in one and stands single in the other
    repeats."""
    a, b = [t.removesuffix("?") for t in wrapper], [t.removesuffix("?") for t in other]
    key = lambda t: t[1:-2] if t.endswith(")+") else t
    out: list[str] = []
    for op, i, j, k, m in SequenceMatcher(None, [key(t) for t in a], [key(t) for t in b], autojunk=False).get_opcodes():
        if op == "equal":
            for x, y, wx, wy in zip(a[i:j], b[k:m], wrapper[i:j], other[k:m]):
                out.append((x if x.endswith(")+") else y) + ("?" if wx.endswith("?") or wy.endswith("?") else ""))
        else:
            out += [t + "?" for t in a[i:j]] + [t + "?" for t in b[k:m]]
    return fold(out)


def wrapper_of(streams: list[str]) -> list[str]:
    """Iterative alignment of a host's streams."""
    out = streams[0].split("\n") if streams else []
    for s in streams[1:]:
        out = align(out, s.split("\n"))
    return out


def _region(path: str) -> str:
    """The container that a text's path lies in."""
    parts = path.split("/")
    while len(parts) > 1 and parts[-1].partition(".")[0].rstrip("-+~^=") in TEXT_LEVEL:
        parts.pop()
    return "/".join(parts)


def fixed_strings(slots: list[dict]) -> list[str]:
    """Strings of a host that every page with their path has, in regions
    without varying text and outside main elements. ``slots``: path,
    n (pages), chars, linked, keys (up to ``EVIDENCE`` different pages), common (digest
    and length of the texts that all these pages have); path ``PAGE`` is the page."""
    pages = sum(s["n"] for s in slots if s["path"] == PAGE)
    varying = [s["path"] for s in slots if s["path"] != PAGE and s["chars"] > sum(s["n"] * c["chars"] for c in s["common"])]
    alive = {"/".join(parts[:i]) for parts in (path.split("/") for path in varying) for i in range(1, len(parts) + 1)}
    fixed = [s for s in slots if s["path"] != PAGE and len(s["keys"]) >= EVIDENCE and 2 * s["n"] >= pages and not _away(s["path"])
             and not any(part.endswith("+") for part in s["path"].split("/")) and _region(s["path"]) not in alive]
    constant = sum(s["n"] * c["chars"] for s in fixed for c in s["common"])
    if 2 * constant > sum(s["chars"] for s in slots if not _away(s["path"])):
        return []
    return sorted(f"{s['path']}={c['digest']}" for s in fixed for c in s["common"])


def _away(path: str) -> bool:
    return any(part.endswith("-") for part in path.split("/"))


def main_slots(slots: list[dict], strings: list[str]) -> tuple[list[str], list[str]]:
    """A host's main slots (path, ``#``): those inside a main element, and those
    that are read where a page has none of them."""
    lengths = {f"{s['path']}={c['digest']}": s["n"] * c["chars"] for s in slots for c in s["common"]}
    varying = {s["path"]: s["chars"] for s in slots if s["path"] != PAGE and not _away(s["path"])}
    for string in strings:
        varying[string.rpartition("=")[0]] -= lengths[string]
    known = {s["path"] for s in slots if len(s["keys"]) >= EVIDENCE}
    weigh = lambda paths: sum(varying[p] for p in paths if p in known)
    linked = {s["path"]: s["linked"] for s in slots}
    total = {s["path"]: s["chars"] for s in slots}
    worded: dict[str, set[str]] = {}  # outermost region that a word marks -> its paths
    within: dict[str, set[str]] = {}  # region inside a main element, likewise
    gone = set()
    for path in varying:
        parts, main = path.split("/"), False
        for i, part in enumerate(parts):
            main = main or part.endswith("+")
            region = "/".join(parts[:i + 1])
            if part.endswith(("~", "^")) and not main:
                worded.setdefault(region, set()).add(path)
                break
            if part.endswith("^"):
                gone.add(path)
            elif part.endswith("~") and part.partition(".")[0] in CONTAINERS:
                within.setdefault(region, set()).add(path)
    dense = lambda paths: 2 * sum(linked[p] for p in paths) > sum(total[p] for p in paths)
    gone.update(*(paths for paths in within.values() if dense(paths)))
    good = set(varying).difference(gone, *worded.values())
    for paths in worded.values():
        if weigh(paths) > sum(varying[p] for p in varying if p not in paths):
            good |= paths - gone
    if not any(total[p] for p in good):  # words alone do not empty a host
        good = set().union(*(paths for region, paths in worded.items() if not region.endswith("^") and not dense(paths))) - gone
    inside = {p for p in good if any(part.endswith("+") for part in p.split("/"))}
    if weigh(good - inside) > sum(varying[p] for p in inside):
        inside = good
    return sorted(p + "#" for p in inside), sorted(p + "#" for p in good - inside)


SURVEY = "host string, path string, n long, chars long, linked long, keys array<string>, common array<struct<digest:string,chars:long>>"


def _survey(batches):
    seen: dict[tuple, list] = {}
    for batch in batches:
        for host, page in zip(batch_column(batch, "host").to_pylist(), batch_column(batch, "html")):
            slots: dict[str, list] = {}
            whole = blake2b(digest_size=8)
            for path, text, linked in read_page(page.as_py()):
                if text or linked:
                    slot = slots.setdefault(path, [0, 0, set()])
                    slot[0] += len(text)
                    slot[1] += linked
                if text:
                    digest = _digest(text)
                    whole.update(f"{path}={digest}\n".encode())
                    slot[2].add((digest, len(text)))
            key = {whole.hexdigest()}
            slots[PAGE] = [0, 0, set()]
            for path, (chars, linked, texts) in slots.items():
                at = seen.get((host, path))
                if at is None:
                    seen[host, path] = [1, chars, linked, set(key), texts]
                else:
                    at[0] += 1
                    at[1] += chars
                    at[2] += linked
                    at[3] = set(sorted(at[3] | key)[:EVIDENCE])
                    at[4] &= texts
    rows = [{"host": host, "path": path, "n": n, "chars": chars, "linked": linked, "keys": sorted(keys), "common": [{"digest": d, "chars": c} for d, c in sorted(common)]}
            for (host, path), (n, chars, linked, keys, common) in seen.items()]
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("n", pa.int64()), ("chars", pa.int64()), ("linked", pa.int64()), ("keys", pa.list_(pa.string())),
                        ("common", pa.list_(pa.struct([("digest", pa.string()), ("chars", pa.int64())])))])
    for i in range(0, len(rows), 4096):
        yield pa.RecordBatch.from_pylist(rows[i:i + 4096], schema)


def _judge(rows: pa.Table) -> pa.Table:
    slots = rows.to_pylist()
    strings = fixed_strings(slots)
    inside, other = main_slots(slots, strings)
    return pa.table({"host": [slots[0]["host"]], "strings": ["\n".join(strings)], "inside": ["\n".join(inside)], "other": ["\n".join(other)]})


def survey(pages: DataFrame) -> DataFrame:
    """host, strings (fixed ones), inside and other (main slots); lists as
    lines."""
    parts = (pages.select("host", "html").mapInArrow(_survey, SURVEY).groupBy("host", "path")
             .agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.flatten(F.collect_list("keys")).alias("keys"), F.collect_list("common").alias("common")))
    return (parts.withColumn("keys", F.slice(F.array_sort(F.array_distinct("keys")), 1, EVIDENCE))
            .withColumn("common", F.aggregate("common", F.get("common", F.lit(0)), F.array_intersect))
            .groupBy("host").applyInArrow(_judge, "host string, strings string, inside string, other string"))


def _streams(batches):
    for batch in batches:
        seen: dict[tuple, int] = {}
        for host, page, strings in zip(batch_column(batch, "host").to_pylist(), batch_column(batch, "html"), batch_column(batch, "strings").to_pylist()):
            key = (host, stream(page.as_py(), strings))
            seen[key] = seen.get(key, 0) + 1
        yield pa.record_batch([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                               pa.array(list(seen.values()), pa.int64())], names=["host", "stream", "n"])


def template_of(streams: list[str]) -> tuple[list[str], list[str], list[str]]:
    """The wrapper of the streams, its strings, and those without a fixed place."""
    wrapper, most = wrapper_of(streams), Counter()
    for s in streams:
        most |= _strings(s.split("\n"))
    found = _strings(wrapper)
    return wrapper, sorted(found), sorted(s for s, n in found.items() if n > most[s])


def _wrap(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["n", "stream"], ascending=[False, True])
    wrapper, found, moved = template_of(rows.stream.tolist())
    return pd.DataFrame({"host": [rows.host.iloc[0]], "wrapper": ["\n".join(wrapper)], "found": [found], "moved": [moved]})


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (of each group of streams, lines of tokens) and template
    (lines: the wrapper's strings) of pages with the host's ``strings``."""
    counted = (pages.select("host", "html", "strings").mapInArrow(_streams, "host string, stream string, n long")
               .groupBy("host", "stream").agg(F.sum("n").alias("n")))
    parts = F.ceil(F.count("*").over(Window.partitionBy("host")) / STREAMS)
    found = (counted.withColumn("part", F.pmod(F.xxhash64("stream"), parts)).groupBy("host", "part")
             .applyInPandas(_wrap, "host string, wrapper string, found array<string>, moved array<string>"))
    union = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    return found.groupBy("host").agg(F.sort_array(F.collect_list("wrapper")).alias("wrapper"),
                                     F.array_join(F.array_sort(F.array_except(union("found"), union("moved"))), "\n").alias("template"))


def _texts(batches):
    for batch in batches:
        out = []
        for page, template, inside, other in zip(batch_column(batch, "html"), *(batch_column(batch, c).to_pylist() for c in ("template", "inside", "other"))):
            blocks = [(path, text) for path, text, _ in read_page(page.as_py()) if text]
            inside, other = _lines(inside), _lines(other)
            # a page without the host's main element is read by the other slots
            use = inside if any(path + "#" in inside for path, _ in blocks) else other
            out.append("\n".join(text for path, text in blocks if path + "#" in use and not string_of(path, text, template)))
        yield pa.record_batch([batch_column(batch, "page_id"), batch_column(batch, "url"), pa.array(out, pa.string()),
                               pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars."""
    rows = (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
            .withColumn("host", host_path(F.col("url"))[0]))

    def with_hosts(found):
        size = found.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
        if size <= broadcast_bytes:  # else a shuffled join, whose hot hosts are split
            found = F.broadcast(found)
        return rows.join(found, F.col("host") == F.col("w_host"), "left")

    judged = keep(survey(rows).withColumnRenamed("host", "w_host"))
    template = wrappers(with_hosts(judged.select("w_host", "strings"))).select(F.col("host").alias("w_host"), "template")
    found = keep(judged.join(template, "w_host", "left").select("w_host", "template", "inside", "other"))
    return (with_hosts(found).select("page_id", "url", "html", "template", "inside", "other")
            .mapInArrow(_texts, "page_id long, url string, text string, n_chars long"))
