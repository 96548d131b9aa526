"""Main text of web pages by equivalence classes of tokens over the pages of a host.

Tokens (start tags and runs of text, in their path) that occur equally often in each page of a host form an equivalence class.
Classes that hold in nearly all pages, without tokens that change places, and that nest in one slot of the largest
class, are the host's template. The stretches between the tokens of the largest class are its slots. The slot with most text
outside links over the host's pages, and those like it, hold the main text; text that is a token of the template is none.
What elements and class words name as beside the article goes from inside a slot (comments or adverts that only some pages
have), and they choose alone where a host has no template.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh, table, without

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# Element names by what they mean in HTML.
RAW = frozenset("script style noscript template textarea title iframe svg annotation annotation-xml xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr img math semantics mi mn mo ms mtext mrow mstyle mfrac msqrt mroot msub msup msubsup munder mover munderover".split())
ASIDE = frozenset("nav footer aside form button select menu dialog head object audio video canvas".split())
CONTENT = frozenset(["article", "main"])
# An end tag may be left out: a start tag of the left closes an open element of the right.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
BLOCKS_CLOSE_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol pre section table ul".split())
# Words of a class, id or role that name something beside the article.
NOISE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar notice notices cookie cookies consent popup modal overlay newsletter subscribe signup comment comments respond replies disqus share sharing social related recommended widget toolbar pagination pager login search complementary contentinfo alert".split())
#: Those that an article itself doesn't use for its parts; inside it only these count, as a whole name.
NEVER_TEXT = NOISE - frozenset("alert notice notices related recommended share social search comment promotion login banner menu overlay toolbar signup subscribe respond complementary contentinfo masthead footer navigation".split())
#: Those that make a whole article or main something else, as one of its names.
CONTENT_NOISE = frozenset("ad ads advert advertisement sponsored promo comment comments cookie cookies consent popup modal sidebar nav navigation menu".split())
BROADCAST_TOKENS = 500_000
SUMS = ["letters", "linked", "plain", "own", "inner"]
_WORDS = re.compile(r"[A-Za-z]+")


def noisy(attributes: str, whole: frozenset[str] | None = None) -> bool:
    """Whether a class, id or role names a part beside the article; with `whole`, only if it is one of these names.

    A name that begins with has, with, no or without says what else a layout holds, not what it is.
    """
    for m in NAMED.finditer(attributes):
        for name in re.sub(r"(?<=[a-z])(?=[A-Z])", " ", m[1] or m[2] or m[3] or "").split() if whole is None else (m[1] or m[2] or m[3] or "").lower().split():
            if whole is not None:
                if name in whole:
                    return True
                continue
            words = [w.lower() for w in _WORDS.findall(name)]
            if words and words[0] not in ("has", "with", "no", "without") and any(w in NOISE for w in words):
                return True
    return False


def runs(page: str) -> Iterator[tuple[int, str, bool, bool, bool, bool]]:
    """What a page is made of, in order: (path, text, starts a block, aside, in content, in a link).

    The text of a start tag is ''. The path is a 64-bit name of the open elements with their classes, so that deep pages
    cost no more than flat ones; markup that closes nothing is left out, elements left open end with their parent.
    """
    stack: list[tuple[str, int, bool, bool]] = []  # name, path, aside, in content
    open_now: Counter[str] = Counter()

    def pop() -> str:
        name = stack.pop()[0]
        open_now[name] -= 1
        return name

    at, size, fresh = 0, len(page), True
    path, aside, inside, link = 0, False, False, False
    while at < size:
        m = TAG.search(page, at)
        end = m.start() if m else size
        if end > at:
            yield path, page[at:end], fresh, aside, inside, link
            fresh = False
        if not m:
            return
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, closing, attributes = name.lower(), (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if name in RAW and not closing:
            if not attributes.endswith("/"):
                close = re.compile(f"</{name}\\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else size
            continue
        block = name not in INLINE
        fresh |= block
        link = not closing if name == "a" else link
        if closing:
            if open_now[name] > 0:
                while pop() != name:
                    pass
        else:
            shut = CLOSES.get(name, frozenset()) | ({"p"} if name in BLOCKS_CLOSE_P else frozenset())
            while stack and (stack[-1][0] in shut or stack[-1][0] in INLINE and block and any(open_now[x] > 0 for x in shut)):
                pop()
            path = stack[-1][1] if stack else 0
            kind = NAMED.search(attributes) if attributes else None
            path = xxhash.xxh64_intdigest(f"{path}/{name}" + (f".{kind[0].strip()}" if kind else ""))
            aside, inside = (stack[-1][2], stack[-1][3]) if stack else (False, False)
            # A content element goes by its whole names, what is inside one by fewer of them.
            names = NEVER_TEXT if inside else CONTENT_NOISE if name in CONTENT else None
            aside |= name in ASIDE or bool(kind) and name not in ("html", "body") and noisy(attributes, names)
            inside |= name in CONTENT and not aside
            # A header inside an article holds its title; one outside, the site's.
            aside |= name == "header" and not inside
            yield path, "", True, aside, inside, link
            if name not in VOID and not attributes.endswith("/") and (block or kind):
                stack.append((name, path, aside, inside))
                open_now[name] += 1
        path, aside, inside = stack[-1][1:] if stack else (0, False, False)


def token(path: int, text: str) -> int:
    """64-bit name of a token: a start tag, or a run of text, in its path."""
    return xxhash.xxh64_intdigest(f"{path}\0{' '.join(text.split())}".encode("utf-8", "surrogatepass")) - (1 << 63)


@dataclass(frozen=True)
class Template:
    """Tokens of a host's valid classes, those of its largest class, and those of them after which a menu or main text stands."""

    tokens: frozenset[int] = frozenset()
    root: frozenset[int] = frozenset()
    menus: frozenset[int] = frozenset()
    main: frozenset[int] = frozenset()


def extract(page: str, template: Template = Template()) -> str:
    """Main text of a page, from the main slots of its host's template.

    Runs of text that are template tokens go, and so do all outside the main slots. Of the others, those inside an article
    or main that is not aside count if there are any, else all; what is aside (menus, headers, footers, adverts, forms,
    comments) never. A page without text in main slots, or of a host without them, is read whole; then runs in a menu slot
    that are not in an article or main go.
    """
    inner: list[str] = []
    outer: list[str] = []
    slot = 0
    for path, text, fresh, aside, inside, _ in runs(page):
        name = token(path, text) if template.tokens and (not text or not text.isspace()) else 0
        if name in template.root:
            slot = name
        if not text:
            continue
        gone = aside or name in template.tokens or (slot not in template.main if template.main else slot in template.menus and not inside)
        for out, own in ((inner, inside), (outer, True)):
            if fresh:
                out.append(" ")
            if own and not gone:
                out.append(entities.unescape(text))
    clean = lambda x: " ".join("".join(x).split())
    found = clean(inner) or clean(outer)
    return extract(page, replace(template, main=frozenset())) if not found and template.main else found


def host_of(url: str) -> Column:
    """Host of a URL column, lower-case; what has none is its own host ''."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)), F.lit(""))


def places(page: str, root: dict[int, int], classes: dict[int, tuple[int, int]]) -> dict[int, list[int]]:
    """For each token of the classes (token -> class and its size), where it stands in a page.

    [least and greatest place among its class's tokens, least and greatest root token before it]. Places count within a
    class, from 0 again after each whole class.
    """
    out: dict[int, list[int]] = {}
    seen: Counter[int] = Counter()
    slot = 0
    for path, text, *_ in runs(page):
        if text and text.isspace():
            continue
        name = token(path, text)
        if (known := classes.get(name)) is not None:
            kind, size = known
            place = seen[kind] % size
            seen[kind] += 1
            at = out.setdefault(name, [place, place, slot, slot])
            at[0], at[1], at[2], at[3] = min(at[0], place), max(at[1], place), min(at[2], slot), max(at[3], slot)
        if name in root:
            slot = name
    return out


def letters(page: str, template: Template, out: dict[int, list[int]]) -> None:
    """Add to out, for the slot after each root token: its letters, those in links, those of its own text outside links, and of
    these those not aside and those in an article or main. Own text is no token of the template."""
    at = None
    for path, text, _, aside, inside, link in runs(page):
        if text and text.isspace():
            continue
        name = token(path, text)
        if name in template.root:
            at = out.setdefault(name, [0] * len(SUMS))
        elif text and at is not None:
            own = len(text) * (name not in template.tokens and not link)
            for k, n in enumerate((len(text), len(text) * link, own, own * (not aside), own * (inside and not aside))):
                at[k] += n


def templates(pages: DataFrame, *, url: str = "url", html: str = "html", least_pages: int = 5, share: float = 0.9, class_size: int = 3, menu: float = 0.8) -> DataFrame:
    """host, tokens, root, menus and main (see Template) of each host with at least least_pages different pages.

    Equal pages of a host count once. A class holds the tokens with one occurrence vector (told by a hash of page
    and count over its pages) and must have class_size tokens and occur in `share` of the pages. Tokens that do not
    always stand at the same place among the class's leave it. It is valid if class_size tokens stay, and if it is the
    host's largest class or all of its tokens always stand in one and the same slot of that. A slot is a menu if over all pages `menu` of its letters, and more,
    are in links. Of the others, the slot with most letters outside links is main, and so is one of whose such letters half
    or more are of the same kind: in an article or main if half of the first one's are, else not aside. Counts are summed before they are shuffled, so a host with any share of the pages is dealt like others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                hosts, names, pagehashes, counts = [], [], [], []
                for host, page in zip(part["host"].to_pylist(), part["html"].to_pylist()):
                    here = Counter(token(r[0], r[1]) for r in runs(page or "") if not r[1] or not r[1].isspace())
                    h = token(0, page or "")
                    hosts += [host] * len(here)
                    names += here.keys()
                    pagehashes += [h] * len(here)
                    counts += here.values()
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(names, pa.int64()), pa.array(pagehashes, pa.int64()), pa.array(counts, pa.int32())], ["host", "token", "page", "n"])

    some = pages.select(host_of(url).alias("host"), F.col(html).alias("html"))
    tokens = some.mapInArrow(run, "host string, token long, page long, n int")
    tokens = tokens.groupBy("host", "token", "page").agg(F.max("n").alias("n"))
    vectors = tokens.groupBy("host", "token").agg(F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count("*").alias("pages"))
    hosts = some.select("host", F.xxhash64("html").alias("h")).distinct().groupBy("host").agg(F.count("*").alias("all")).filter(F.col("all") >= least_pages)
    vectors = vectors.filter(F.col("pages") >= least_pages * share).join(hosts, "host").filter(F.col("pages") >= share * F.col("all"))
    sizes = vectors.groupBy("host", "vector").agg(F.count("*").cast("int").alias("size")).filter(F.col("size") >= class_size)
    largest = sizes.groupBy("host").agg(F.max(F.struct("size", "vector")).alias("top"))
    classes = cut(vectors.select("host", "vector", "token").join(sizes, ["host", "vector"]).join(largest, "host").select("host", "token", "vector", "size", (F.col("top.vector") == F.col("vector")).alias("root")))

    # Second pass: places of the classes' tokens, in the pages of hosts that have classes.
    by_host = classes.groupBy("host").agg(F.collect_list(F.struct("token", "vector", "size", "root")).alias("classes"))
    small = F.broadcast(by_host) if by_host.agg(F.coalesce(F.sum(F.size("classes")), F.lit(0))).first()[0] <= BROADCAST_TOKENS else by_host

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[dict, dict]] = {}
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                rows = []
                for host, page, found in zip(part["host"].to_pylist(), part["html"].to_pylist(), part["classes"]):
                    if host not in seen:
                        if len(seen) > 200:
                            seen.clear()
                        known = found.as_py()
                        seen[host] = ({c["token"]: 1 for c in known if c["root"]}, {c["token"]: (c["vector"], c["size"]) for c in known})
                    rows += [(host, t, *v) for t, v in places(page or "", *seen[host]).items()]
                columns = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], ["host", "token", "lo", "hi", "slot_lo", "slot_hi"])

    stood = some.join(small, "host").mapInArrow(place, "host string, token long, lo long, hi long, slot_lo long, slot_hi long")
    stood = stood.groupBy("host", "token").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("slot_lo").alias("slot_lo"), F.max("slot_hi").alias("slot_hi"))
    stood = cut(classes.join(stood, ["host", "token"]).filter("lo = hi"))
    nested = F.max("root") | (F.min("slot_lo") == F.max("slot_hi"))
    valid = stood.groupBy("host", "vector").agg((F.count("*") >= class_size).alias("whole"), nested.alias("nested")).filter("whole and nested").select("host", "vector")
    stood = stood.join(valid, ["host", "vector"])
    held = cut(stood.groupBy("host").agg(F.collect_list("token").alias("tokens"), F.collect_list(F.when(F.col("root"), F.col("token"))).alias("root")))

    # Third pass: what the slots hold.
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Template] = {}
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                sums: dict[str, dict[int, list[int]]] = {}
                for host, page, tokens, root in zip(part["host"].to_pylist(), part["html"].to_pylist(), part["tokens"], part["root"]):
                    if host not in seen:
                        if len(seen) > 1000:
                            seen.clear()
                        seen[host] = Template(frozenset(tokens.as_py()), frozenset(root.as_py()))
                    letters(page or "", seen[host], sums.setdefault(host, {}))
                rows = [(host, t, *v) for host, slots in sums.items() for t, v in slots.items()]
                columns = list(zip(*rows)) or [()] * (2 + len(SUMS))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], ["host", "token", *SUMS])

    few = held.agg(F.coalesce(F.sum(F.size("tokens") + F.size("root")), F.lit(0))).first()[0] <= BROADCAST_TOKENS
    slots = some.join(F.broadcast(held) if few else held, "host").mapInArrow(fill, "host string, token long, " + ", ".join(f"{c} long" for c in SUMS))
    slots = slots.groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in SUMS])
    linked = (F.col("letters") > 0) & (F.col("linked") >= menu * F.col("letters"))
    holds = lambda *what: F.when(~linked & (F.col("plain") > 0), F.struct(*what))
    slots = slots.groupBy("host").agg(F.collect_list(F.when(linked, F.col("token"))).alias("menus"), F.max(holds("plain", "token", "inner")).alias("top"), F.collect_list(holds("plain", "token", "inner", "own")).alias("slots"))
    alike = "filter(slots, s -> s.token = top.token or 2 * if(2 * top.inner >= top.plain, s.inner, s.own) >= s.plain)"
    main = F.expr(f"transform({alike}, s -> s.token)")
    none = F.array().cast("array<long>")
    return held.join(slots.select("host", "menus", main.alias("main")), "host", "left").select("host", "tokens", "root", F.coalesce("menus", none).alias("menus"), F.coalesce("main", none).alias("main"))


def main_text(pages: DataFrame, *, url: str = "url", html: str = "html", out: str = "main_text") -> DataFrame:
    """pages with `out`, the main text of the html.

    Character references are decoded, white space inside a block is one space, blocks are joined in page order by
    one space. A null or empty html, or one without content, gives ''; truncated markup is read as far as it goes; a
    page of a host with few pages is read without a template; null urls are one host. Repeated rows give repeated
    rows; other columns pass through, but one named `out` is replaced. Templates go to the workers by broadcast if
    they have BROADCAST_TOKENS tokens (of up to four longs) or less, by a shuffled join if more.
    """
    pages = without(pages, out)
    names = pages.columns
    host, template = fresh(pages, "host", "template")
    known = templates(pages, url=url, html=html)
    known = cut(known.select(F.col("host").alias("of_host"), F.struct("tokens", "root", "menus", "main").alias(template)))
    few = known.agg(F.coalesce(F.sum(F.size(F.col(template)["tokens"])), F.lit(0))).first()[0] <= BROADCAST_TOKENS
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    all_of = pages.withColumn(host, host_of(url)).join(F.broadcast(known) if few else known, F.col(host) == known["of_host"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Template] = {}
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                got = []
                for name, found, page in zip(part[host].to_pylist(), part[template], part[html].to_pylist()):
                    if name not in seen:
                        if len(seen) > 1000:
                            seen.clear()
                        seen[name] = Template(**{k: frozenset(v) for k, v in found.as_py().items()}) if found.is_valid else Template()
                    got.append(extract(page or "", seen[name]))
                yield pa.RecordBatch.from_arrays([*[part[n] for n in names], pa.array(got, pa.string())], [*names, out])

    return all_of.select(*names, host, template).mapInArrow(run, f"{kinds}, `{out}` string")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
