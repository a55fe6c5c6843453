"""Main text of web pages by composite text density.

A page becomes a tree of its block elements. Every block has a composite density: its characters
per tag, times a logarithm that shrinks it the more of its text stands in links. A block's
density sum adds the densities of its child blocks; the block with the largest sum is the core.
The smallest density on the way from the core up to the body is the threshold: every block that
reaches it, and whose parents do, gives the subtree with the largest density sum in it. Headings that
lead to such a subtree and unlinked blocks between two of them belong to the text. An article
or main is a hint: one not mostly of links need not reach the threshold, and half is enough inside. Blocks that
name themselves as something else (navigation, forms, adverts, comments) are taken out, but only if
their density also speaks against them: see ``veto``.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.batches import bound_batches

# HTML's element names.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math canvas object select".split())
UNREAD = frozenset("head button".split())
NAMED = frozenset("nav footer aside form dialog menu".split())
CLOSED_BY_BLOCK = frozenset(["p"])
CLOSED_BY_LIKE = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "body": frozenset(["head"]),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())
# Where the search for an element to close stops.
SCOPES = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"])}
# Words of class, id and role that name something other than the article.
OTHER = re.compile(
    r"ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|side-?bar|nav|nav-?bar|navigation|"
    r"menu|foot(?:er)?|comments?|comment-?list|replies|respond|disqus|cookies?|cookie-(?:notice|banner|bar|consent)|consent|notice|"
    r"pop-?up|modal|overlay|share|sharing|social|related|recommended|breadcrumbs?|newsletter|subscribe|log-?in|sign-?up|search|"
    r"pagination|pager|widget|complementary|contentinfo|toolbar|skip-link",
    re.I,
)
# Parts of a name that say where or what kind of box it is, but not what is in it.
BOX_PARTS = frozenset(
    "area bar block body bottom box buttons col column container content global holder inner left links list main outer page panel posts primary "
    "right root row secondary section site slot thread top wrap wrapper".split()
)
NAME_PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
PAGE_HEADER = re.compile(r"header|masthead|topbar", re.I)
COMMENT = re.compile(r"comments?", re.I)
# A named block stays only if it is more times as dense as the densest other one.
NAME_FACTOR = 4

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # Quotes hold a value only behind an equals sign.
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>=]*(?:=\s*(?:\"[^\"]*\"|'[^']*'|)[^>=]*)*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
SPACE = re.compile(r"\s+")


class Block:
    __slots__ = ("name", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "density", "total", "named", "own")

    def __init__(self, name: str, parent: Block | None, named: bool = False) -> None:
        self.name, self.parent, self.named = name, parent, named
        self.parts: list[str | Block] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _values(attributes: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)} if attributes else {}


def _is_unread(name: str, values: dict[str, str]) -> bool:
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "")
    return name in UNREAD or hidden


def _is_named(name: str, values: dict[str, str], stack: list[tuple[str, Block | None]]) -> bool:
    """Whether a block names itself as something other than the article."""
    inside = any(n in ("article", "main") for n, _ in stack)
    if name in NAMED or (name == "header" and not inside):
        return True
    words = " ".join(html.unescape(values.get(k, "")) for k in ("class", "id", "role")).split()
    if name in ("main", "article"):
        return name == "article" and any(COMMENT.fullmatch(w) for w in words)
    return any(_names_other(w) or (not inside and PAGE_HEADER.fullmatch(w)) for w in words)


def _names_other(word: str) -> bool:
    """Whether a name says something other than the article, by itself or once the parts for boxes are left out.

    ``comments-area`` and ``site-footer`` do; ``has-sidebar`` and ``comments-open`` say something of their own.
    """
    if OTHER.fullmatch(word):
        return True
    parts = NAME_PARTS.split(word)
    told = [p for p in parts if p.lower() not in BOX_PARTS]
    return 0 < len(told) < len(parts) and OTHER.fullmatch("-".join(told)) is not None


def parse(page: str) -> Block:
    """The tree of a page's block elements; inline elements only count as tags of their block."""
    root = Block("body", None)
    # Open elements by name, with their block; None for inline ones and inside of what is left out.
    stack: list[tuple[str, Block | None]] = []
    block, at, skipped, links = root, 0, 0, 0

    def text(part: str) -> None:
        if part and not skipped:
            decoded = html.unescape(part)
            count = len(SPACE.sub(" ", decoded).strip())
            block.parts.append(decoded)
            block.chars += count
            if links:
                block.link_chars += count

    def close(depth: int) -> None:
        nonlocal block, skipped, links
        while len(stack) > depth:
            name, own = stack.pop()
            if name.startswith("!"):
                skipped -= 1
            elif name == "a":
                links -= 1
            elif own is not None:
                block = own.parent or root

    while True:
        found = TAG.search(page, at)
        if found is None:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        name, ending = found[2].lower(), bool(found[1])
        if ending:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0].lstrip("!") == name), None)
            if depth is not None:
                close(depth)
            elif name in ("p", "br") and not skipped:
                block.parts.append(" ")
            continue
        if name in RAW:
            if not found[3].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in BLOCKS:
            closed = CLOSED_BY_LIKE.get(name, frozenset())
            scope = SCOPES.get(name, frozenset(["table"]) if closed else frozenset())
            depth = len(stack)
            for d in range(len(stack) - 1, -1, -1):
                open_name = stack[d][0].lstrip("!")
                if open_name in scope:
                    break
                if open_name in CLOSED_BY_BLOCK or open_name in closed:
                    depth = d
                elif open_name in BLOCKS and not closed:
                    break
            close(depth)
        if name in VOID:
            if not skipped:
                block.tags += 1
                if name in ("br", "hr", "wbr"):
                    block.parts.append(" " if name != "wbr" else "")
            continue
        values = {} if skipped else _values(found[3])
        if skipped or _is_unread(name, values):
            skipped += 1
            stack.append(("!" + name, None))
            continue
        if name in ("html", "body"):
            stack.append((name, None))
        elif name in BLOCKS:
            own = Block(name, block, _is_named(name, values, stack))
            block.parts.append(own)
            block = own
            stack.append((name, own))
        else:
            block.tags += 1
            if name == "a":
                links += 1
                block.link_tags += 1
            stack.append((name, None))
    for own in _in_order(root):
        own.own = (own.chars, own.tags, own.link_chars, own.link_tags)
    return root


def _in_order(root: Block) -> list[Block]:
    out, waiting = [], [root]
    while waiting:
        block = waiting.pop()
        out.append(block)
        waiting.extend(p for p in reversed(block.parts) if isinstance(p, Block))
    return out


def measure(root: Block) -> list[Block]:
    """All blocks in page order with their density and density sum."""
    blocks = _in_order(root)
    for block in blocks:
        block.density = 0.0
        block.chars, block.tags, block.link_chars, block.link_tags = block.own
    for block in reversed(blocks):
        for child in block.parts:
            if isinstance(child, Block):
                block.chars += child.chars
                block.tags += child.tags + 1
                block.link_chars += child.link_chars
                block.link_tags += child.link_tags
    share = root.link_chars / max(root.chars, 1)
    for block in blocks:
        if block.chars:
            tags, link_tags, linked = max(block.tags, 1), max(block.link_tags, 1), max(block.link_chars, 1)
            unlinked = max(block.chars - block.link_chars, 1)
            base = math.log(block.chars / unlinked * block.link_chars + share * block.chars + math.e)
            block.density = block.chars / tags * math.log(block.chars / linked * tags / link_tags + 1) / base
    for block in blocks:
        block.total = sum(child.density for child in block.parts if isinstance(child, Block))
    return blocks


def veto(root: Block) -> None:
    """Takes named blocks out of the tree.

    One stays that holds an article, a main or the core of the page, or at least half of the
    unlinked text; on pages without article and main also one that is more than ``NAME_FACTOR`` times
    as dense as the densest other block. Beside an article or main, a nav or footer never stays by its size.
    Those inside of one that stays are judged alike. So is a teaser: an article beside that of the core whose first
    heading is a link, as of a story told elsewhere, if the core's own article has no such heading.
    """
    blocks = measure(root)
    core = max(blocks, key=lambda b: b.total)
    kept = {id(b) for b in _path(core)} if core.total else set()
    hints = [b for b in blocks if b.name == "main" or (b.name == "article" and not b.named)]
    teasers = _teasers(blocks, core, hints)
    hints = [b for b in hints if id(b) not in teasers]
    for block in hints:
        _add_path(block, kept)
    inside: set[int] = set()
    for block in blocks:
        if block.named or id(block.parent) in inside:
            inside.add(id(block))
    bar = NAME_FACTOR * max((b.density for b in blocks if id(b) not in inside and b is not root), default=0.0)
    unlinked = root.chars - root.link_chars
    out: set[int] = set(teasers)
    for block in blocks:
        large = 0 < unlinked <= 2 * (block.chars - block.link_chars)
        stays = (large and block.name not in ("nav", "footer")) if hints else (large or block.density > bar > 0)
        if block.named and id(block) not in kept and not stays:
            out.add(id(block))
    for block in blocks:
        # What is left beside one taken out stays apart.
        block.parts = [" " if id(p) in out else p for p in block.parts]


def _teasers(blocks: list[Block], core: Block, hints: list[Block]) -> set[int]:
    """Articles outside the core's own one, with a linked first heading, if that of the core has none."""
    path = {id(b) for b in _path(core)}
    own = next((b for b in _path(core) if b.name == "article"), None)
    if own is None or _has_linked_heading(own):
        return set()
    within = {id(own)}
    for block in blocks:
        if id(block.parent) in within:
            within.add(id(block))
    outside = [b for b in hints if b.name == "article" and id(b) not in path and id(b) not in within]
    return {id(b) for b in outside if _has_linked_heading(b)}


def _has_linked_heading(block: Block) -> bool:
    first = next((b for b in _in_order(block) if b.name in HEADINGS and b.chars), None)
    return first is not None and _linked(first)


def _path(block: Block) -> list[Block]:
    out = [block]
    while out[-1].parent is not None:
        out.append(out[-1].parent)
    return out


def _add_path(block: Block | None, known: set[int]) -> None:
    while block is not None and id(block) not in known:
        known.add(id(block))
        block = block.parent


def _linked(block: Block) -> bool:
    return 2 * block.link_chars >= block.chars


def chosen(root: Block) -> list[Block]:
    """The blocks whose whole text belongs to the main text, in page order, none inside another.

    A body that is the core itself gives its own text and all blocks in it but sparse ones mostly of links.
    """
    veto(root)
    blocks = measure(root)
    core = max(blocks, key=lambda b: b.total)
    threshold = min(b.density for b in _path(core))
    if core is root:
        root.parts = [" " if isinstance(p, Block) and _linked(p) and p.density < threshold else p for p in root.parts]
        return [root]
    # The block with the largest density sum in each subtree; the outermost of equal ones.
    best = {id(b): b for b in blocks}
    for block in reversed(blocks):
        for part in block.parts:
            if isinstance(part, Block) and best[id(part)].total > best[id(block)].total:
                best[id(block)] = best[id(part)]
    # Blocks with a kept one in them, and kept ones.
    marked: set[int] = set()
    holders: set[int] = set()
    waiting = [(root, False)]
    while waiting:
        block, hinted = waiting.pop()
        own_hint = block.name in ("article", "main")
        enough = (own_hint and not _linked(block)) or block.density >= (threshold / 2 if hinted else threshold)
        if id(block) in marked or not block.chars or not enough:
            continue
        # Nothing mostly of links is text beside the core.
        found = best[id(block)]
        if found is core or not _linked(found):
            marked.add(id(found))
            _add_path(found, holders)
        waiting.extend((p, hinted or own_hint) for p in block.parts if isinstance(p, Block))
    for block in reversed(blocks):
        if id(block) in holders and id(block) not in marked:
            _bridge([p for p in block.parts if isinstance(p, Block)], marked, holders)
    out, inside = [], set()
    for block in blocks:
        if id(block.parent) in inside:
            inside.add(id(block))
        elif id(block) in marked:
            inside.add(id(block))
            out.append(block)
    return out


def _bridge(beside: list[Block], marked: set[int], holders: set[int]) -> None:
    """Marks headings before kept blocks, and unlinked ones between kept blocks, of those beside each other."""
    at = [i for i, b in enumerate(beside) if id(b) in holders]
    first, last = at[0] if at else 0, at[-1] if at else -1
    heads = [i for i in range(first) if beside[i].name in HEADINGS and not _linked(beside[i])]
    for block in beside[min([*heads, first]) : last]:
        if id(block) not in holders and not _linked(block):
            marked.add(id(block))


def block_texts(top: Block) -> list[str]:
    """Texts of a block and those in it, in page order: white space is one space, empty ones are left out."""
    lines, current = [], []

    def flush() -> None:
        line = SPACE.sub(" ", "".join(current)).strip()
        if line:
            lines.append(line)
        current.clear()

    waiting: list[str | Block | None] = [top]
    while waiting:
        part = waiting.pop()
        if isinstance(part, str):
            current.append(part)
            continue
        flush()
        if part is not None:
            waiting.append(None)
            waiting.extend(reversed(part.parts))
    flush()
    return lines


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n".join(line for block in chosen(parse(page)) for line in block_texts(block))


def _extract(html_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(html_at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*batch.schema.names, "text", "n_chars"],
            )

    return run


def extract_text(pages: DataFrame, page: str = "html") -> DataFrame:
    """Pages with the ``text`` of their article and its ``n_chars`` (code points).

    Every row is read whole and alone. A null or empty page, or one without text, gives an empty
    text. All input columns return; those named ``text`` or ``n_chars`` are replaced, unless one
    is the page itself, which is an error. Repeated rows are answered alike.
    """
    if page in ("text", "n_chars"):
        raise ValueError(f"the page's column cannot be named {page!r}")
    bound_batches(pages.sparkSession)
    pages = pages.drop("text", "n_chars")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pages.schema)}, text string, n_chars long"
    return pages.mapInArrow(_extract(pages.columns.index(page)), schema)
