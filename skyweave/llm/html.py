"""Main text of web pages by two passes of block rules.

The first pass judges each block by itself: where it stands, its share of link text, its length and its density of stop words.
Short and doubtful blocks stay undecided. In the second pass they take the label of the nearest decided blocks.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH_LOW = 70
LENGTH_HIGH = 200
STOP_LOW = 0.30
STOP_HIGH = 0.32
LINKS_OUTSIDE = 0.2
LINKS_INSIDE = 0.6
LIFT_TIMES = 4
DEEPEST = 16
"""Marks inside one another that are told apart."""

# Frequent function words of some languages.
STOP_WORDS = frozenset(
    """
    a about after all also an and any are as at be been but by can could did do for from had has have he her his how i if in
    into is it its just like more my no not now of on one only or other our out over she so some than that the their them
    then there these they this to up was we were what when which who will with would you your
    au aux avec ce ces cette comme dans de des donc du elle elles en est et il ils je la le les leur lui mais me même ne nos
    notre nous ou où par pas plus pour qu que qui sa sans se ses son sont sur tout tu un une vos votre vous
    aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für hat hatte
    ich ihr im in ist ja kann man mehr mit nach nicht noch nur oder sehr sein sich sie sind so über um und uns unter vom von vor
    war wenn werden wie wir wird zu zum zur
    al como con cuando de del desde dos el ella en entre era es esta este están fue ha hay la las le lo los más me mi muy
    no nos o para pero por porque que quien se ser si sin sobre su sus también tiene un una uno y ya
    al alla che chi come con da dal dei del della di e gli ho il io la le lo ma mi nel nella non per più se si sono sul un una
    à ao às com da das do dos e ela ele em entre era eu foi mais mas na não no nos o os ou para pela pelo por que se sem seu sua
    aan als bij dat de die dit door een en er het hij ik in is je maar met naar niet of om ook op te tot uit van voor was wat ze
    """.split()
)

# Element names by what they do to the text.
RAW = frozenset("script style noscript template svg math iframe object textarea select title canvas audio video".split())
BREAKING = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
    section summary table tbody td tfoot th thead tr ul""".split()
)
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
APART = frozenset("nav footer aside form menu dialog button search head".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu".split())
APART_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist
    consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter
    notice notices notification overlay pager pagination popup promo promotion promoted recommended related replies respond
    share sharing sidebar signup skyscraper social sponsor sponsored subscribe subscription toolbar widget widgets""".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus related recommended replies respond".split())
# Of these nothing is lifted: what readers say, what stands elsewhere, and what nobody sees.
FIRM = frozenset(
    "hidden nav footer aside menu dialog button search head header navigation banner contentinfo complementary alertdialog alert".split()
) | {w.upper() for w in COMMENT_WORDS}
TRANSIENT = frozenset("ad ads adv advert advertisement banner consent cookie cookies gdpr notice overlay popup promo".split())
MAIN_WORDS = frozenset("article content main post entry story articlebody maincontent".split())

# All repeats are possessive and stop at the next "<", so broken markup costs no more than good markup.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)
    |<(/?)([a-zA-Z][^\s/<>"']*+)((?:[^<>"']|"[^"]*+"|'[^']*+')*+)>
    |<(/?)([a-zA-Z][^\s/<>"']*+)([^<>]*+)>
    |<[!?/][^<>]*+>""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""(?i)\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z]+")
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int
    """Characters in links."""
    apart: bool
    """Within menus, footers, adverts, forms and the like."""
    main: int
    """The main container the block stands in, 0 for none."""
    heading: bool
    marks: tuple[int, ...] = ()
    """The elements that set it apart, as numbers; -1 for one that is not to be lifted."""
    label: str = ""


def _place(name: str, attributes: str) -> tuple[str, bool]:
    """Why an element stands apart ('' if it doesn't), by a word in capitals if its class or id says so, and whether it is a main container."""
    found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
    words = set()
    for part in (found.get("class", "") + " " + found.get("id", "")).split():
        if not part.startswith(("has-", "with-", "no-", "without-", "js-")):
            words.update(_WORD.findall(part))
    role = found.get("role", "")
    if name in ("html", "body"):
        return "", False
    if "hidden" in found or found.get("aria-hidden") == "true":
        return "hidden", False
    if name in APART:
        return name, False
    if role in APART_ROLES:
        return role, False
    main = name in ("article", "main") or role in ("main", "article") or bool(words & MAIN_WORDS)
    if name != "main" and (words & APART_WORDS):
        return min(words & APART_WORDS, key=lambda w: (w not in COMMENT_WORDS, w in TRANSIENT, w)).upper(), main
    return "", main


def blocks(page: str) -> list[Block]:
    """The page's blocks of text in order, with references decoded and white space made single spaces."""
    out: list[Block] = []
    # Open elements: name, why it stands apart, the marks of it and of those around it, the main container it is in.
    stack: list[tuple[str, str, tuple[int, ...], int]] = [("", "", (), 0)]
    open_names: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0
    link = False
    mains = 0
    numbers = 0
    breaks = 0
    at = 0

    def flush():
        nonlocal linked, breaks
        breaks = 0
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                _, _, marks, main = stack[-1]
                heading = any(open_names[h] for h in HEADINGS)
                out.append(Block(text, min(linked, len(text)), bool(marks), main, heading, marks))
            parts.clear()
        linked = 0

    def say(raw: str):
        nonlocal linked, breaks
        if not raw:
            return
        text = entities.unescape(raw)
        parts.append(text)
        if not text.isspace():
            breaks = 0
            if link:
                linked += len(" ".join(text.split()))

    while True:
        token = _TOKEN.search(page, at)
        if token is None:
            say(page[at:])
            break
        say(page[at : token.start()])
        at = token.end()
        name = (token[2] or token[5] or "").lower()
        if not name:
            if token[0].startswith("<![CDATA["):
                say(entities.unescape(token[0][9:].removesuffix("]]>")).replace("&", "&amp;"))
            continue
        closing, attributes = bool(token[1] or token[4]), token[3] or token[6] or ""
        if name in RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            parts.append(" ")
            continue
        if name == "a":
            link = not closing
            continue
        if name == "br":
            breaks += 1
            if breaks > 1:
                flush()
            parts.append(" ")
            continue
        if name not in BREAKING:
            continue
        flush()
        link = False
        if name in EMPTY:
            continue
        if closing:
            while open_names[name]:
                last = stack.pop()[0]
                open_names[last] -= 1
                if last == name:
                    break
            continue
        if stack[-1][0] == "p" or (name == "body" and stack[-1][0] == "head"):
            open_names[stack.pop()[0]] -= 1
        if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1][0] == name:
            open_names[stack.pop()[0]] -= 1
        why, main = _place(name, attributes)
        _, _, marks, within = stack[-1]
        if name == "header" and not within:
            why = why or "header"
        if main and why not in FIRM:
            mains += 1
            within = mains
            if marks and not why and name in ("article", "main") and all(not x[1] or x[1].lower() in TRANSIENT for x in stack):
                # An advert or a notice that was never closed.
                stack[:] = [(x[0], "", (), x[3]) for x in stack]
                marks = ()
        if why:
            numbers += 1
            # More marks than a few say no more, and a page of open elements stays cheap.
            marks = (-1,) if why in FIRM or -1 in marks or len(marks) >= DEEPEST else (*marks, numbers)
        stack.append((name, why, marks, within))
        open_names[name] += 1
    flush()
    return out


def _first_pass(block: Block) -> str:
    length = len(block.text)
    if block.apart:
        return "apart"
    if block.linked > length * (LINKS_INSIDE if block.main else LINKS_OUTSIDE):
        return "bad"
    if not block.main and "\N{COPYRIGHT SIGN}" in block.text:
        return "bad"
    if length < LENGTH_LOW:
        return "bad" if block.linked and not block.main else "short"
    words = _LETTERS.findall(block.text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if density >= STOP_HIGH:
        return "good" if length > LENGTH_HIGH else "near"
    return "near" if density >= STOP_LOW or block.main else "thin"


def lifted(found: list[Block]) -> None:
    """Take back the marks around the main text where they stand around the page instead of beside its text.

    A form or the name of a class is only a hint: some pages are one form, and some wrappers are called after the sidebar in them.
    Where no unmarked main container has any text, the marks that most of the good text has are lifted, if it is
    LIFT_TIMES the good text without any mark; marks within, as of a real sidebar, stay. Reader comments, menus, footers and what is
    hidden are never lifted.
    """
    if any(b.main and not b.marks for b in found):
        return
    weight: Counter[tuple[int, ...]] = Counter()
    for b in found:
        if -1 in b.marks:
            continue
        free = Block(b.text, b.linked, False, b.main, b.heading)
        if _first_pass(free) in ("good", "near"):
            weight[b.marks] += len(b.text)
    plain = weight.pop((), 0)
    if not weight:
        return
    best, size = max(weight.items(), key=lambda x: (x[1], -len(x[0])))
    if size > LIFT_TIMES * plain:
        for b in found:
            if b.marks and set(b.marks) <= set(best):
                b.marks, b.apart = (), False


def labelled(found: list[Block]) -> list[Block]:
    """Blocks with the label good or bad.

    Blocks apart are bad and no neighbours. The edge of a main container counts as good for the blocks in it, the edge of the page
    as bad for the blocks outside. An undecided block between two good ones is good, between two bad ones bad;
    between one of each it follows the nearer, a near-good block and a heading the good one. On a page without a main
    container and without a good block, all undecided blocks are good: there is nothing that speaks against them.
    """
    lifted(found)
    first = [_first_pass(b) for b in found]
    plain = not any(b.main and not b.apart for b in found) and "good" not in first
    for i, (block, label) in enumerate(zip(found, first)):
        if label in ("good", "bad", "apart") or plain:
            block.label = "bad" if label in ("bad", "apart") else "good"
            continue
        sides = []
        for step in (-1, 1):
            j, distance = i + step, 1
            while 0 <= j < len(found) and (first[j] not in ("good", "bad") or found[j].main != block.main):
                if found[j].main != block.main and block.main and first[j] != "apart":
                    j = -1
                    break
                j += step
                distance += 1
            inside = 0 <= j < len(found)
            sides.append((first[j] if inside else ("good" if block.main else "bad"), distance))
        (before, near), (after, far) = sides
        if before == after:
            block.label = before
        elif label == "near" or (block.heading and after == "good"):
            block.label = "good"
        else:
            block.label = before if near < far else after if far < near else "bad"
    return found


def main_text(page: str | None) -> tuple[str, int, int]:
    """Text of the good blocks joined by newlines, number of blocks, number of good blocks."""
    found = labelled(blocks(page or ""))
    kept = [b.text for b in found if b.label == "good"]
    return "\n".join(kept), len(found), len(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(x.as_py()) for x in batch.column("html")]
        texts = [x[0] for x in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(x) for x in texts], pa.int64()),
                pa.array([x[1] for x in found], pa.int32()),
                pa.array([x[2] for x in found], pa.int32()),
            ],
            names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"],
        )


def extracted(pages: DataFrame) -> DataFrame:
    """A row per page: page_id, url, text, n_chars, n_blocks, n_kept.

    Pages are independent: one pass, no shuffle. Null and empty html give an empty text; ids and urls come through as they
    are, null included; broken markup is read as far as it goes; repeated rows give equal rows, an empty table an empty result.
    Other columns are not looked at.
    """
    return pages.select("page_id", "url", F.col("html")).mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long, n_blocks int, n_kept int"
    )
