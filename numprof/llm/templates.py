"""Main text of web pages by template deduction over equivalence classes.

Every page is cut into tokens: elements, told apart by the chain of elements
around them, and texts (blocks), told apart by their element.  A token's
occurrence vector says how often it stands on each distinct page of its host;
tokens with the same vector form a class.  A text is the template's if it
stands on most of the pages that have its element, and either equally often on
each or in a class that has elements.  What the slots between such tokens hold
is the pages' own text; a constant heading between texts of a page's own is
its own, too, and a page without any keeps what is not framed.

Of that, frames (menus, adverts, comments and the like) are left out, which
element and class names give away, unless one wraps nearly all the text that
varies between the pages.  ``article`` and ``main`` are taken alone where the
other slots hold next to nothing.

Vectors are kept as counts and a sum of hashes over the whole host, added up
by Spark, so a host is never held or cut in pieces.  Elements on fewer than a
thousandth of a host's pages are folded into the nearest element around them
that is not, which bounds what is known of a host; pages meet the template
of their host in a join, and are shuffled, compressed, only if the templates
are too many to be broadcast.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numprof.plans.stats_join import attach_by_keys

from .common import released, written

#: Pages, and bytes of html, whose tokens a task adds up before it passes them on.
GROUP_PAGES, GROUP_BYTES = 64, 64 << 20
#: Pages that a text of the template stands on at least, and their share of
#: the host's pages that have its element.
MIN_SUPPORT, SUPPORT = 4, 0.8
#: Share of a host's pages that an element of its template stands on at least.
ELEMENT_SHARE = 0.001
#: Varying text of the slots to prefer over that of all others, in multiples.
CLEAR = 4

# Element and attribute names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset("address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th "
                   "thead title tr ul".split())
MAIN = frozenset("article main".split())
FRAME = frozenset("nav header footer aside form script style noscript button select menu dialog template iframe object svg canvas head title "
                  "textarea label input audio video map noembed noframes xmp".split())
FRAME_WORDS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
                        "notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer "
                        "header masthead comment comments disqus reply replies share sharing social related recommended newsletter subscribe signup "
                        "login search pagination pager toolbar copyright legal skip".split())

COMMENT_WORDS = frozenset("comment comments disqus reply replies".split())
#: First words of classes that say what an element has or lacks, not what it is.
STATES = frozenset("no not has have with without is hide show".split())
#: Last words of classes that only say that an element holds something.
HOLDERS = frozenset("area bar block body box button buttons container content details form group holder icon icons inner item items left link links "
                    "list main outer panel right row section slot text title top bottom wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text is not on the page.
UNSEEN = frozenset("script style noscript template iframe object svg canvas head title textarea select audio video noembed noframes xmp".split())

_MASK = (1 << 64) - 1
_DIGITS = re.compile(r"\d+")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG = re.compile(r"""<[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*>""")
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Contexts:
    """Elements by the chain of elements around them; one number for each, and
    a key that is the same in every task.

    ``frame`` and ``main`` are hints of element and class names.  ``soft``
    elements are frames by a class or id alone, or forms: ``Template`` opens
    one again that wraps the text of its host's pages.
    """

    def __init__(self):
        self.number: dict[tuple[int, str], int] = {}
        self.parent, self.name, self.key, self.label = [-1], [""], [0], [""]
        self.own, self.soft, self.frame, self.main, self.shown = [False], [False], [False], [False], [True]

    def child(self, parent: int, name: str, attrs: str) -> int:
        label = name + _DIGITS.sub("0", attrs)
        found = self.number.get((parent, label))
        if found is None:
            found = self.number[parent, label] = len(self.name)
            marks = [m.groups() for m in _ATTR.finditer(attrs)]
            named = [x for _, a, b, c in marks for x in (a or b or c or "").lower().split()]
            words = {w for x in named for w in _frame_words(x)}
            own_main = name in MAIN or "main" in {(a or b or c or "").lower() for k, a, b, c in marks if k.lower() == "role"}
            hidden = any(k.lower() == "hidden" for k, *_ in marks)
            own = name in FRAME or hidden or (bool(words & FRAME_WORDS) and name not in ("html", "body"))
            self.parent.append(parent)
            self.name.append(name)
            self.label.append(label)
            self.key.append(xxhash.xxh64_intdigest(label.encode(), self.key[parent] & _MASK) - (1 << 63))
            self.own.append(own)
            self.soft.append(own and not hidden and (name not in FRAME or name == "form") and not words & COMMENT_WORDS & set(named))
            # A frame around an article outranks it, and so does its own class.
            self.frame.append(own or self.frame[parent])
            self.main.append(own_main or self.main[parent])
            self.shown.append(self.shown[parent] and not hidden and name not in UNSEEN)
        return found

    def is_frame(self, context: int, opened: set[int]) -> bool:
        """Whether a frame holds the context, those with keys ``opened`` not counting."""
        if not opened or not self.frame[context]:
            return self.frame[context]
        while context > 0:
            if self.own[context] and self.key[context] not in opened:
                return True
            context = self.parent[context]
        return False


def _frame_words(name: str) -> list[str]:
    """The words of a class or id that name its element: the last, or all of
    those before words that only say it holds something; none if it says what
    the element has or lacks."""
    words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
    if len(words) > 1 and words[0] in STATES:
        return []
    while len(words) > 1 and (words[-1] in HOLDERS or words[-1].isdigit()):
        words.pop()
        if words[-1] not in HOLDERS:
            return words
    return words[-1:]


def _label(tag: str, name: str) -> str:
    """The attributes that tell elements of one name apart, as written."""
    rest = tag[1 + len(name):-1]
    return "".join(" " + m.group(0).strip() for m in _ATTR.finditer(rest)) if rest else ""


def tokens(page: str, contexts: Contexts) -> list[tuple[int, str | None, bool]]:
    """The page as (context, text or None for an element's start, whether a
    block ends here); linear in the length of the page.

    Comments, declarations, scripts and styles give nothing.  Unclosed
    comments and raw elements reach to the end of the page, as in browsers.
    """
    out: list[tuple[int, str | None, bool]] = []
    stack, names, at, n = [0], [""], 0, len(page)
    open_names: Counter = Counter()

    def pop_to(name: str, stop: frozenset) -> None:
        for k in range(len(names) - 1, 0, -1):
            if names[k] == name:
                for x in names[k:]:
                    open_names[x] -= 1
                del names[k:], stack[k:]
                return
            if names[k] in stop:
                return

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            out.append((stack[-1], page[at:lt], False))
        if lt >= n:
            break
        nxt = page[lt + 1:lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = end + 3 if end >= 0 else n
        elif nxt in ("!", "?"):
            end = page.find(">", lt)
            at = end + 1 if end >= 0 else n
        elif nxt == "/" and page[lt + 2:lt + 3].isalpha():
            end = page.find(">", lt)
            end = n if end < 0 else end
            name = _NAME.match(page, lt + 2).group().lower()
            if open_names[name]:
                pop_to(name, frozenset())
            if name in BLOCKS:
                out.append((stack[-1], "", True))
            at = end + 1
        elif nxt.isalpha() and nxt.isascii():
            m = _TAG.match(page, lt)
            end = m.end() if m else page.find(">", lt) + 1 or n
            tag = page[lt:end]
            name = _NAME.match(tag, 1).group().lower()
            block = name in BLOCKS
            if block and open_names["p"]:
                pop_to("p", _CLOSES_NO_P)
            if name == "li" and open_names["li"]:
                pop_to("li", _LISTS)
            context = contexts.child(stack[-1], name, _label(tag, name))
            out.append((context, None, block))
            at = end
            if name in RAW:
                close = _RAW_END[name].search(page, end)
                stop = close.start() if close else n
                if name in ("title", "textarea"):
                    out.append((context, page[end:stop], False))
                at = page.find(">", stop) + 1 if close else n
                at = at or n
                if block:
                    out.append((stack[-1], "", True))
            elif name not in VOID and not tag.endswith("/>"):
                stack.append(context)
                names.append(name)
                open_names[name] += 1
        else:
            out.append((stack[-1], "<", False))
            at = lt + 1
    return out


_CLOSES_NO_P = frozenset("article main section div td th li blockquote body html table nav aside header footer form".split())
_LISTS = frozenset("ul ol menu".split())


def blocks(page: list[tuple[int, str | None, bool]]) -> Iterator[tuple[int, str]]:
    """(context of its first text, text) of each non-empty block of a page."""
    parts, where, blank = [], 0, True
    for context, text, ends in page:
        if ends:
            joined = " ".join(html.unescape("".join(parts)).split()) if parts else ""
            if joined:
                yield where, joined
            parts, blank = [], True
        elif text:
            if blank:
                where, blank = context, not text.strip()
            parts.append(text)
    joined = " ".join(html.unescape("".join(parts)).split()) if parts else ""
    if joined:
        yield where, joined


def pieces(page: list[tuple[int, str | None, bool]], wanted) -> list[tuple[int, str]]:
    """Blocks of the texts whose context ``wanted`` accepts."""
    return list(blocks([t for t in page if t[2] or t[1] is None or wanted(t[0])]))


def _texts(page: list[tuple[int, str | None, bool]], contexts: Contexts) -> list[tuple[int, str]]:
    """All blocks of a page, those in frames apart from the others."""
    return (pieces(page, lambda c: contexts.shown[c] and not contexts.frame[c])
            + pieces(page, lambda c: contexts.shown[c] and contexts.frame[c]))


def _text_key(context_key: int, block: str) -> int:
    return (xxhash.xxh64_intdigest(block.encode(), context_key & _MASK) - (1 << 63)) or 1


#: A token on the pages of one host; text 0 is the element itself, and chars
#: those of its blocks.  low and high: fewest and most times on a page that
#: has it; vector: sum of a hash of page and times.
TOKEN = pa.schema([("host", pa.string())] + [(n, pa.int64()) for n in ("context", "text", "parent")] + [("label", pa.string())]
                  + [(n, pa.int64()) for n in ("pages", "total", "low", "high", "vector", "chars")])


class Tokens:
    """Occurrence vectors of the tokens of pages, by host."""

    def __init__(self):
        self.contexts = Contexts()
        self.found: dict[tuple, list[int]] = {}

    def add(self, host: str, uid: int, page: str) -> list[tuple[int, str | None, bool]]:
        cut, key = tokens(page, self.contexts), self.contexts.key
        counts: Counter = Counter((c, 0) for c, text, _ in cut if text is None)
        chars: Counter = Counter()
        counts[0, 0] = 1
        for c, block in _texts(cut, self.contexts):
            k = (c, _text_key(key[c], block))
            counts[k] += 1
            chars[k] += len(block)
            chars[c, 0] += len(block)
        hashes = {n: xxhash.xxh32_intdigest(f"{uid} {n}") for n in set(counts.values())}
        for k, n in counts.items():
            row = self.found.get((host, *k))
            if row is None:
                self.found[host, *k] = [1, n, n, n, hashes[n], chars[k]]
            else:
                row[0] += 1
                row[1] += n
                row[2] = min(row[2], n)
                row[3] = max(row[3], n)
                row[4] += hashes[n]
                row[5] += chars[k]
        return cut

    def rows(self) -> list[tuple]:
        """As ``TOKEN``; parent and label are those of elements."""
        x = self.contexts
        return [(host, x.key[c], text, None if text or not c else x.key[x.parent[c]], None if text or not c else x.label[c], *row)
                for (host, c, text), row in self.found.items()]


def opened_frames(elements: list[tuple[int, int | None, str | None, int]], fixed: dict[int, int]) -> set[int]:
    """Keys of the soft frames that wrap the varying text of a host.

    ``elements``: key, parent, label and chars; ``fixed``: chars of template
    texts by element.
    """
    contexts, number, todo = Contexts(), {0: 0}, {}
    for key, parent, label, _ in elements:
        if label is not None:
            todo.setdefault(parent, []).append((key, label))
    queue = [0]
    while queue:
        parent = queue.pop()
        for key, label in todo.get(parent, ()):
            name = label.split(" ", 1)[0]
            number[key] = contexts.child(number[parent], name, label[len(name):])
            queue.append(key)
    size = len(contexts.name)
    everything, varying = [0] * size, [0] * size
    for key, _, _, chars in elements:
        everything[number[key]] += chars
        varying[number[key]] += chars - fixed.get(key, 0)
    mass = varying if sum(varying) else everything
    below, wraps = list(mass), [False] * size
    for c in range(size - 1, 0, -1):  # children have higher numbers
        parent = contexts.parent[c]
        below[parent] += below[c]
        wraps[parent] |= below[c] > 0 and (wraps[c] or contexts.name[c] in BLOCKS)
    opened: set[int] = set()
    while True:
        framed = [contexts.is_frame(c, opened) for c in range(size)]
        clean = sum(m for m, f in zip(mass, framed) if not f)
        outer = [c for c in range(1, size) if framed[c] and not framed[contexts.parent[c]] and contexts.soft[c] and wraps[c]]
        best = max(outer, key=lambda c: below[c], default=0)
        if not best or 2 * below[best] <= below[0] or CLEAR * clean > below[best]:
            return opened
        opened.add(contexts.key[best])


def slots(page: list[tuple[int, str | None, bool]], contexts: Contexts, opened: set[int], fixed: set[int]) -> str:
    """Main text of a page, given its host's opened frames and template texts."""
    framed: dict[int, bool] = {}

    def wanted(c: int) -> bool:
        if c not in framed:
            framed[c] = not contexts.shown[c] or contexts.is_frame(c, opened)
        return not framed[c]

    found = pieces(page, wanted)
    own = [_text_key(contexts.key[c], b) not in fixed for c, b in found]
    # A constant heading between a page's own texts heads what follows it.
    last = max((k for k, o in enumerate(own) if o), default=-1)
    first = own.index(True) if last >= 0 else 0
    kept = [o or (first < k < last and _in_heading(contexts, c)) for k, ((c, _), o) in enumerate(zip(found, own))]
    inside = sum(len(b) for (c, b), o in zip(found, own) if o and contexts.main[c])
    outside = sum(len(b) for (c, b), o in zip(found, own) if o and not contexts.main[c])
    mains = sum(text is None and contexts.main[c] and not contexts.main[contexts.parent[c]] and wanted(c) for c, text, _ in page)
    # Several articles beside other text may be cards: one of them must outweigh it.
    if mains and CLEAR * mains * outside <= inside:
        return "\n".join(b for c, b in found if contexts.main[c])
    # A page of template texts alone keeps them: it has no slot that holds more.
    return "\n".join(b for (_, b), k in zip(found, kept if last >= 0 else [True] * len(found)) if k)


def _in_heading(contexts: Contexts, c: int) -> bool:
    while c > 0:
        if contexts.name[c] in HEADINGS:
            return True
        c = contexts.parent[c]
    return False


def extract(pages: list[str | None]) -> list[str]:
    """Main text of each of the pages, all of one host, held in memory."""
    seen, done = Tokens(), {}
    for k, p in enumerate(pages):
        if (p or "") not in done:  # equal pages count once
            done[p or ""] = seen.add("", k, p or "")
    rows = [dict(zip(TOKEN.names, r)) for r in seen.rows()]
    elements = {r["context"]: r for r in rows if not r["text"]}
    classes = {_class(r) for r in elements.values()}
    fixed = [r for r in rows if r["text"] and _recurs(r, elements[r["context"]], classes)]
    opened, texts = _host_template(list(elements.values()), fixed)
    return [slots(done[p or ""], seen.contexts, opened, texts) for p in pages]


def _class(token: dict) -> tuple:
    """The equivalence class of a token: equal for equal occurrence vectors."""
    return token["pages"], token["total"], token["vector"]


def _recurs(text: dict, element: dict, classes: set[tuple]) -> bool:
    """Whether a text is the template's; ``main_text`` says the same in SQL."""
    return (text["pages"] >= max(MIN_SUPPORT, SUPPORT * element["pages"])
            and (text["low"] == text["high"] or _class(text) in classes))


def _host_template(elements: list[dict], fixed: list[dict]) -> tuple[set[int], set[int]]:
    """Opened frames and template texts of a host."""
    chars: Counter = Counter()
    for r in fixed:
        chars[r["context"]] += r["chars"]
    return opened_frames([(r["context"], r["parent"], r["label"], r["chars"]) for r in elements], chars), {r["text"] for r in fixed}


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = pa.array([None if x is None else press.compress(x.encode()) for x in batch.column("html").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in range(3)] + [packed], names=["page_id", "url", "host", "html"])


def _tokens(group_pages: int, group_bytes: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, count, size = Tokens(), 0, 0
        for batch in batches:
            for host, uid, page in zip(*(batch.column(c) for c in ("host", "uid", "html"))):
                page = page.as_py() or ""
                seen.add(host.as_py(), uid.as_py(), page)
                count, size = count + 1, size + len(page)
                if count >= group_pages or size >= group_bytes:
                    yield _token_batch(seen)
                    seen, count, size = Tokens(), 0, 0
        if count:
            yield _token_batch(seen)
    return step


def _token_batch(seen: Tokens) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*seen.rows()), TOKEN.types)], schema=TOKEN)


def _hosts(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    opened, texts = _host_template([r for r in rows if not r["text"]], [r for r in rows if r["text"]])
    keys = [np.array(sorted(k), np.int64).tobytes() for k in (opened, texts)]
    return pa.table({"h": pa.array([rows[0]["host"]]), "opened": pa.array(keys[:1], pa.binary()), "fixed": pa.array(keys[1:], pa.binary())})


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpress = zstandard.ZstdDecompressor()
    keys = lru_cache(1024)(lambda k: frozenset(np.frombuffer(k, np.int64).tolist()))
    for whole in batches:
        for at in range(0, whole.num_rows, GROUP_PAGES):
            batch, contexts, texts = whole.slice(at, GROUP_PAGES), Contexts(), []
            for x, opened, fixed in zip(*(batch.column(c) for c in ("html", "opened", "fixed"))):
                page = unpress.decompress(x.as_py()).decode() if x.is_valid else ""
                texts.append(slots(tokens(page, contexts), contexts, keys(opened.as_py() or b""), keys(fixed.as_py() or b"")))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def _distinct_pages(rows: DataFrame) -> DataFrame:
    """(host, uid, html) of one row for each distinct html of a host.  Only
    digests are grouped; rows meet those that repeat, html stays in place."""
    tagged = rows.select("host", "html", F.xxhash64("html").alias("uid"), F.coalesce(F.octet_length("html"), F.lit(0)).alias("size"),
                         F.monotonically_increasing_id().alias("tag"))
    copies = tagged.groupBy("host", "uid", "size").agg(F.count(F.lit(1)).alias("n"), F.min("tag").alias("first"))
    copies = written(copies.filter("n > 1").select("host", "uid", "size", "first"), "page-copies")
    if copies.isEmpty():
        return tagged.select("host", "uid", "html")
    marked = attach_by_keys(tagged, copies, ["host", "uid", "size"])
    return marked.filter(F.col("first").isNull() | (F.col("first") == F.col("tag"))).select("host", "uid", "html")


def _folded(elements: DataFrame) -> DataFrame:
    """The elements that stand on at least ``ELEMENT_SHARE`` of their host's
    pages, with the text of others below them counted as theirs: at most
    1 / ELEMENT_SHARE times as many a host as a page has.

    The others look for their nearest kept element by pointer doubling.
    """
    c = F.col
    most = elements.groupBy("host").agg(F.max("pages").alias("host_pages"))
    sized = attach_by_keys(elements, written(most, "host-pages"), ["host"])
    keep = c("pages") >= ELEMENT_SHARE * c("host_pages")
    kept = sized.filter(keep | c("parent").isNull()).drop("host_pages")
    loose = written(sized.filter(~keep & c("parent").isNotNull()).select("host", "context", c("parent").alias("up"), "chars"), "loose-elements")
    if loose.isEmpty():
        return kept
    while True:
        ends = loose.select(c("host").alias("h"), c("context").alias("at"), c("up").alias("further"))
        step = loose.join(ends, (c("host") == c("h")) & (c("up") == c("at")), "left")
        if step.filter("further IS NOT NULL").isEmpty():
            break
        loose = written(step.select("host", "context", F.coalesce("further", "up").alias("up"), "chars"), "loose-elements")
    more = loose.groupBy("host", "up").agg(F.sum("chars").alias("more")).select(c("host").alias("h"), "up", "more")
    joined = kept.join(more, (c("host") == c("h")) & (c("context") == c("up")), "left")
    return joined.withColumn("chars", c("chars") + F.coalesce("more", F.lit(0))).select(*elements.columns)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              group_pages: int = GROUP_PAGES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Per row of ``pages``: id, url, ``text`` (blocks joined by line breaks)
    and ``n_chars``.

    A NULL or empty html has an empty text; pages with a NULL url, or one
    without a host, form a host of their own; repeated rows give repeated
    results, and count once in the template; an empty table gives an empty result; other columns are ignored.
    ``group_pages`` and ``group_bytes`` set the load of a step, not the result.
    """
    c = F.col
    host = F.regexp_extract(F.lower(F.coalesce(c(url_col), F.lit(""))), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    rows = pages.select(c(id_col).alias("page_id"), c(url_col).alias("url"), host.alias("host"), c(html_col).alias("html"))
    found = _distinct_pages(rows).mapInArrow(
        released(_tokens(group_pages, group_bytes)),
        "host string, context bigint, text bigint, parent bigint, label string, pages bigint, total bigint, low bigint, high bigint, vector bigint, chars bigint")
    found = found.groupBy("host", "context", "text", "parent", "label").agg(
        *[f(n).alias(n) for f, n in ((F.sum, "pages"), (F.sum, "total"), (F.min, "low"), (F.max, "high"), (F.sum, "vector"), (F.sum, "chars"))])
    found = written(found.filter((c("text") == 0) | (c("pages") >= MIN_SUPPORT)), "page-tokens")
    elements = _folded(found.filter("text = 0"))
    own = elements.select(*[c(n).alias("e_" + n) for n in ("host", "context", "pages")])
    fixed = found.filter("text <> 0").join(own, (c("host") == c("e_host")) & (c("context") == c("e_context")))
    vector = ["host", "pages", "total", "vector"]
    classes = written(elements.select(*vector).distinct().withColumn("classed", F.lit(True)), "element-classes")
    fixed = fixed.filter(c("pages") >= SUPPORT * c("e_pages")).join(classes, vector, "left")
    fixed = fixed.filter((c("low") == c("high")) | c("classed")).select(*found.columns)
    hosts = elements.select(*found.columns).unionByName(fixed).select("host", "context", "text", "parent", "label", "chars").groupBy("host").applyInArrow(
        _hosts, "h string, opened binary, fixed binary")
    hosts = written(hosts, "host-templates")
    ids = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in ("page_id", "url"))
    packed = rows.mapInArrow(released(_packed), f"{ids}, host string, html binary").join(hosts, c("host") == c("h"), "left")
    out = packed.select("page_id", "url", "html", "opened", "fixed").mapInArrow(released(_extracted), f"{ids}, text string")
    return out.select(c("page_id").alias(id_col), c("url").alias(url_col), "text", F.length("text").cast("bigint").alias("n_chars"))
