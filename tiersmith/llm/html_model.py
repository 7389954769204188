"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a node with two states, content or not. A node's potential is log-linear in
its tag, class and role words, text length and link density; parent and child share a 2x2 potential.
Sum-product messages, first upward from the leaves and then downward from the root, give the exact
marginal of every node; the text blocks of nodes over one half are the main text. The weights are
fitted by gradient ascent on the likelihood (expected counts from the same messages) of a bounded
set of labelled pages, which ``labelled_pages`` builds from a rule.

The work is per page, nothing is shuffled. Defined cases: a null or empty html has the empty text;
markup without a close is closed by its parent, also where its text is never page text (button, select,
svg and the like; only script, style, textarea and title hold all up to their close); text outside any
element belongs to the page's root;
rows that repeat a page get equal results; pages of any length are read whole.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = frozenset(
    "html body main article section div p ul ol li nav header footer aside form table thead tbody tr td th h1 h2 h3 h4 h5 h6"
    " blockquote pre figure figcaption dl dt dd address fieldset details summary dialog menu center hgroup search".split()
)
# Their text is never page text.
SILENT = frozenset("script style noscript template title textarea select svg iframe object canvas audio video button".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# An element that closes an open one of the second list, up to an element of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
}
TAG_GROUPS = {
    "article": "article", "main": "main", "text": "p blockquote pre figcaption", "heading": "h1 h2 h3 h4 h5 h6 hgroup", "list": "ul ol dl menu",
    "item": "li dt dd", "nav": "nav search", "header": "header", "footer": "footer address", "aside": "aside dialog details summary",
    "form": "form fieldset", "box": "div section center figure", "table": "table thead tbody tr td th", "root": "html body",
}
GROUP_OF = {tag: group for group, tags in TAG_GROUPS.items() for tag in tags.split()}
WORDS = {
    "w_menu": "nav navbar menu breadcrumb breadcrumbs pagination pager toolbar tabs skip toc topbar",
    "w_frame": "header footer masthead copyright legal bottom top sitefooter siteheader",
    "w_side": "sidebar side aside related recommended widget more popular trending rail",
    "w_advert": "ad ads advert advertisement adbox banner promo promotion sponsor sponsored teaser",
    "w_notice": "cookie cookies consent notice gdpr popup modal overlay alert newsletter subscribe signup login paywall",
    "w_comment": "comment comments reply replies discussion respond disqus reviews responses",
    "w_social": "share sharing social follow tags meta byline tools",
    "w_content": "article content main post entry story text body prose articlebody entrycontent maincontent",
    "r_frame": "navigation banner contentinfo complementary search dialog alert form menu",
    "r_content": "main article",
}
WORD_OF = {word: name for name, words in WORDS.items() if name[0] == "w" for word in words.split()}
ROLE_OF = {word: name for name, words in WORDS.items() if name[0] == "r" for word in words.split()}
NAMES = ["bias", *TAG_GROUPS, *WORDS, "hidden", "in_article", "in_main", "in_content", "in_other", "log_text", "links", "sentence", "deep_text", "share"]
PLACE = {name: i for i, name in enumerate(NAMES)}
# Marks of parts around the content, also inside it: what stands below one of them is told so.
OTHER = [PLACE[n] for n in ("nav", "header", "footer", "aside", "form", "w_menu", "w_side", "w_advert", "w_notice", "w_comment", "r_frame", "hidden")]


@dataclass
class Node:
    tag: str
    parent: int
    flags: tuple[str, ...] = ()
    chars: int = 0
    link_chars: int = 0
    ends: int = 0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    # Text blocks in page order: node and text.
    blocks: list[tuple[int, str]] = field(default_factory=list)


TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))|\b(hidden)\b""")
# From one attribute to the next: its name, and its value up to the quote that opens it (group 1) or to its end.
STEP = re.compile(r"""[ \t\n\r\f/]*[^ \t\n\r\f/>]?[^ \t\n\r\f/>=]*(?:[ \t\n\r\f]*=[ \t\n\r\f]*(?:(["'])|[^ \t\n\r\f>]*))?""")
TOKEN = re.compile(r"[a-z]+")


def flags_of(tag: str, attributes: str) -> tuple[str, ...]:
    out = set()
    if attributes and not attributes.isspace():
        for name, a, b, c, hidden in ATTRIBUTE.findall(attributes):
            value = (a or b or c).lower()
            name = name.lower()
            if name in ("class", "id"):
                words = TOKEN.findall(value)
                out.update(WORD_OF[w] for w in [*words, "".join(words)] if w in WORD_OF)
            elif name == "role":
                out.update(ROLE_OF[w] for w in TOKEN.findall(value) if w in ROLE_OF)
            elif hidden or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                out.add("hidden")
    return tuple(out)


def tag_end(text: str, at: int, dead: set[int]) -> int:
    """Where the tag whose attributes begin at ``at`` ends: at the first ">" outside a quoted value; -1 if there is no ">".

    A tag that does not end so, as a quote stays open or the page is over, ends at its first ">". ``dead``
    keeps the places from which a walk found no end, so that no part of a page is walked again and again.
    """
    first = text.find(">", at)
    if first < 0 or text.find('"', at, first) < 0 and text.find("'", at, first) < 0:
        return first
    walked, n = [], len(text)
    while at < n and at not in dead:
        walked.append(at)
        step = STEP.match(text, at)
        at = step.end()
        if step[1]:
            close = text.find(step[1], at)
            if close < 0:
                break
            at = close + 1
        elif text.startswith(">", at):
            return at
    dead.update(walked)
    return first


# A comment may end at once; else it ends with two hyphens, an exclamation mark or none, and the bracket.
COMMENT_END, COMMENT_CLOSE = re.compile("-?>"), re.compile("--!?>")


def parsed(text: str) -> Page:
    """Nodes and text blocks of a page. Unclosed elements end with their parent."""
    page = Page([Node("html", -1)])
    stack = [0]
    inner: list[str] = []
    links = 0
    # An element whose text is not page text, and the silent and block elements open inside it.
    silent: list[str] = []
    # How many elements of each tag are open, so that a tag without a partner is not looked for.
    opened, hushed = Counter(["html"]), Counter()
    dead: set[int] = set()
    at, n = 0, len(text)

    def close_from(k: int) -> None:
        opened.subtract(page.nodes[i].tag for i in stack[k:])
        del stack[k:]

    def speak_from(k: int) -> None:
        hushed.subtract(silent[k:])
        del silent[k:]

    def flush() -> None:
        joined = " ".join("".join(inner).split())
        inner.clear()
        if joined:
            node = page.nodes[stack[-1]]
            node.chars += len(joined)
            node.ends += len(re.findall(r"[.!?。](?:\s|$)", joined))
            page.blocks.append((stack[-1], joined))

    def say(part: str) -> None:
        if part and not silent:
            part = entities.unescape(part) if "&" in part else part
            inner.append(part)
            if links:
                page.nodes[stack[-1]].link_chars += len(" ".join(part.split()))

    def ended_by(tag: str, closing: bool) -> int:
        """Place in the stack and then in ``silent`` of the element that a block's tag ends, 0 if there is none."""
        ends, stops = ({tag}, ()) if closing else CLOSES.get(tag, ((), ()))
        if not any(opened[t] or hushed[t] for t in ends):
            return 0
        for k in range(len(stack) + len(silent) - 1, 0, -1):
            own = page.nodes[stack[k]].tag if k < len(stack) else silent[k - len(stack)]
            if own in ends:
                return k
            if own in stops or own == "template" and not closing:
                return 0
        return 0

    while at < n:
        lt = text.find("<", at)
        if lt < 0:
            say(text[at:])
            break
        if lt > at:
            say(text[at:lt])
        if text.startswith("<!--", lt):
            end = COMMENT_END.match(text, lt + 4) or COMMENT_CLOSE.search(text, lt + 4)
            at = end.end() if end else n
            continue
        if text.startswith(("<!", "<?"), lt):
            end = text.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        match = TAG.match(text, lt)
        end = tag_end(text, match.end(), dead) if match else -1
        if end < 0:
            say("<")
            at = lt + 1
            continue
        tag, closing = match.group(1).lower(), text[lt + 1] == "/"
        at = end + 1
        if tag in SILENT:
            if closing:
                if hushed[tag]:
                    speak_from(silent.index(tag))
            elif text[end - 1] != "/":
                if tag in RAW:
                    stop = re.compile(f"</{tag}", re.I).search(text, at)
                    close = text.find(">", stop.end()) if stop else -1
                    at = n if close < 0 else close + 1
                else:
                    silent.append(tag)
                    hushed[tag] += 1
            continue
        if silent and tag in BLOCKS:
            k = ended_by(tag, closing)
            if k >= len(stack):
                speak_from(k - len(stack))
            elif k:
                # The block around it ends, and what was left open with it.
                speak_from(0)
        if silent and tag == ("head" if closing else "body") and not opened["body"]:
            speak_from(0)
        if silent:
            if tag in BLOCKS and not closing:
                silent.append(tag)
                hushed[tag] += 1
            continue
        if tag == "a":
            links = max(0, links - 1) if closing else 1
        elif tag == "br" or tag == "hr":
            inner.append(" ")
            if tag == "hr":
                flush()
        elif tag in BLOCKS:
            flush()
            if closing:
                if k := ended_by(tag, closing):
                    close_from(k)
                continue
            links = 0
            if tag == "html":
                continue
            if page.nodes[stack[-1]].tag == "p":
                close_from(len(stack) - 1)
            if tag in CLOSES and (k := ended_by(tag, closing)):
                close_from(k)
            if tag == "body" and opened["body"]:
                continue
            page.nodes.append(Node(tag, stack[-1], flags_of(tag, text[match.end() : end])))
            stack.append(len(page.nodes) - 1)
            opened[tag] += 1
    flush()
    return page


def features(page: Page) -> np.ndarray:
    nodes = page.nodes
    deep = [[n.chars, n.link_chars] for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        up = deep[nodes[k].parent]
        up[0] += deep[k][0]
        up[1] += deep[k][1]
    total = max(1, deep[0][0])
    x = np.zeros((len(nodes), len(NAMES)))
    x[:, 0] = 1
    for k, node in enumerate(nodes):
        if k:
            up = x[node.parent]
            for name, own in (("in_article", "article"), ("in_main", "main"), ("in_content", "w_content")):
                x[k, PLACE[name]] = max(up[PLACE[name]], up[PLACE[own]])
            x[k, PLACE["in_other"]] = up[PLACE["in_other"]] or float(up[OTHER].any())
        x[k, PLACE[GROUP_OF[node.tag]]] = 1
        for flag in node.flags:
            x[k, PLACE[flag]] = 1
        chars, linked = deep[k]
        x[k, PLACE["log_text"]] = math.log1p(node.chars) / 6
        x[k, PLACE["links"]] = min(1.0, linked / max(1, chars))
        x[k, PLACE["sentence"]] = min(1.0, node.ends / 2)
        x[k, PLACE["deep_text"]] = math.log1p(chars) / 8
        x[k, PLACE["share"]] = chars / total
    return x


@dataclass(frozen=True)
class Weights:
    node: np.ndarray
    # Log potential of (parent's state, child's state).
    edge: np.ndarray


def marginals(parents: list[int], score: np.ndarray, edge: np.ndarray) -> tuple[list[float], np.ndarray]:
    """Probability of content for each node, and the expected counts of state pairs over all edges.

    Children come behind their parents, so one pass backward and one forward are all messages.
    """
    n = len(parents)
    w00, w01, w10, w11 = (math.exp(v) for v in edge.ravel())
    one = 1 / (1 + np.exp(-score))
    # Potential times the messages from below, scaled to sum one.
    b1 = one.tolist()
    b0 = (1 - one).tolist()
    up0, up1 = [1.0] * n, [1.0] * n
    for k in range(n - 1, 0, -1):
        s = b0[k] + b1[k]
        x0, x1 = b0[k] / s, b1[k] / s
        b0[k], b1[k] = x0, x1
        m0, m1 = w00 * x0 + w01 * x1, w10 * x0 + w11 * x1
        t = m0 + m1
        up0[k], up1[k] = m0 / t, m1 / t
        p = parents[k]
        b0[p] *= up0[k]
        b1[p] *= up1[k]
        if b0[p] + b1[p] < 1e-200:
            b0[p] *= 1e200
            b1[p] *= 1e200
    s = b0[0] + b1[0]
    out0, out1 = [0.0] * n, [0.0] * n
    out0[0], out1[0] = b0[0] / s, b1[0] / s
    c00 = c01 = c10 = c11 = 0.0
    for k in range(1, n):
        p = parents[k]
        # The parent without what this child told it.
        d0, d1 = out0[p] / up0[k], out1[p] / up1[k]
        j00, j01, j10, j11 = d0 * w00 * b0[k], d0 * w01 * b1[k], d1 * w10 * b0[k], d1 * w11 * b1[k]
        z = j00 + j01 + j10 + j11
        out1[k] = (j01 + j11) / z
        out0[k] = (j00 + j10) / z
        c00, c01, c10, c11 = c00 + j00 / z, c01 + j01 / z, c10 + j10 / z, c11 + j11 / z
    return out1, np.array([[c00, c01], [c10, c11]])


LABELLED = 320
ROUNDS = 150


def labelled_pages(n: int = LABELLED, seed: int = 7) -> list[tuple[str, set[str]]]:
    """Pages built from a rule, and the words that are their content: each word occurs once."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        used: set[str] = set()
        content: set[str] = set()

        def words(count: int, inside: bool) -> str:
            new = []
            while len(new) < count:
                w = "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
                if w not in used:
                    used.add(w)
                    new.append(w)
            if inside:
                content.update(new)
            return " ".join(new)

        def sentence(inside: bool, low: int = 6, high: int = 16) -> str:
            return words(rng.randint(low, high), inside).capitalize() + "."

        def paragraph(inside: bool) -> str:
            link = f' <a href="/x">{words(2, inside)}</a>' if rng.random() < 0.3 else ""
            opening = rng.choice(["<p>", "<p>", "<p><b>"])
            return f"{opening}{' '.join(sentence(inside, rng.choice([2, 6]), 16) for _ in range(rng.randint(1, 5)))}{link}{rng.choice(['</p>', '<br>', '</p>'])}"

        def menu(kind: str) -> str:
            items = "".join(f'<li><a href="/{i}">{words(rng.randint(1, 2), False)}</a></li>' for i in range(rng.randint(2, 8)))
            return {"nav": f"<nav><ul>{items}</ul></nav>", "div": f'<div class="{rng.choice(["menu", "navbar", "breadcrumbs"])}"><ul>{items}</ul></div>'}[kind]

        def advert() -> str:
            name = rng.choice(["ad", "ads", "advert", "banner", "promo", "sponsored"])
            body = rng.choice([sentence(False), f"<p>{sentence(False)}</p>", f'<a href="/b">{words(4, False)}</a>'])
            return f'<div class="{name}">{body}</div>'

        def notice() -> str:
            return f'<div {rng.choice(["class", "id"])}="{rng.choice(["cookie-notice", "consent", "newsletter", "notice"])}"><p>{sentence(False)} {sentence(False)}</p><button>{words(1, False)}</button></div>'

        def form() -> str:
            return f'<form action="/s"><p>{sentence(False)}</p><input name="q"><button>{words(1, False)}</button></form>'

        def comments() -> str:
            each = "".join(f'<div class="comment"><p>{sentence(False)} {sentence(False)}</p></div>' for _ in range(rng.randint(1, 4)))
            tag = rng.choice(["section", "div"])
            return f'<{tag} {rng.choice(["class", "id"])}="comments"><h3>{words(2, False)}</h3>{each}</{tag}>'

        def side() -> str:
            items = "".join(f'<li><a href="/r">{words(3, False)}</a></li>' for _ in range(rng.randint(2, 5)))
            tag = rng.choice(["aside", 'div class="sidebar"', 'div id="related"'])
            return f"<{tag}><h4>{words(2, False)}</h4><ul>{items}</ul><p>{sentence(False)}</p></{tag.split()[0]}>"

        def body() -> str:
            parts = [f"<h1>{words(rng.randint(3, 8), True)}</h1>"] if rng.random() < 0.9 else []
            for _ in range(rng.choice([1, 1, 2, 3, 5, 8])):
                parts.append(paragraph(True))
                if rng.random() < 0.15:
                    parts.append(f"<h2>{words(3, True)}</h2>")
                if rng.random() < 0.12:
                    parts.append(f"<ul><li>{words(4, True)}</li><li>{sentence(True)}</li></ul>")
                if rng.random() < 0.08:
                    parts.append(f"<blockquote><p>{sentence(True)}</p></blockquote>")
                if rng.random() < 0.06:
                    parts.append(f"<table><tr><td>{words(2, True)}</td><td>{words(2, True)}</td></tr></table>")
                if rng.random() < 0.06:
                    parts.append(f"<figure><figcaption>{sentence(True)}</figcaption></figure>")
                if rng.random() < 0.1:
                    parts.append(rng.choice([advert, form, side])())
            return "".join(parts)

        opening = rng.choice(["article", "article", "article", "main", "div class=\"content\"", 'div id="main-content"', 'div class="post"', "main><article", 'section class="story"', "div"])
        tags = [t.split()[0] for t in opening.split("><")]
        wrapped = f"<{opening}>{body()}" + (comments() if rng.random() < 0.15 else "") + "".join(f"</{t}>" for t in reversed(tags))
        before = [menu(rng.choice(["nav", "div"]))] if rng.random() < 0.85 else []
        if rng.random() < 0.5:
            before.insert(0, f"<header><h1>{words(2, False)}</h1><p>{sentence(False, 3, 6)}</p></header>" if rng.random() < 0.5 else f'<div class="header"><p>{words(3, False)}</p></div>')
        before += [f() for f in (advert, notice, form, side) if rng.random() < 0.35]
        after = [f() for f in (comments, side, advert, notice, form) if rng.random() < 0.35]
        if rng.random() < 0.85:
            after.append(f"<footer>&copy; {sentence(False, 3, 9)}</footer>" if rng.random() < 0.6 else f'<div id="footer"><p>&copy; {sentence(False, 3, 9)}</p></div>')
        inner = "".join([*before, wrapped, *after])
        if rng.random() < 0.4:
            inner = f'<div class="{rng.choice(["page", "wrapper", "container"])}">{inner}</div>'
        out.append((f"<html><head><title>{words(3, False)}</title></head><body>{inner}</body></html>", content))
    return out


def node_labels(page: Page, content: set[str]) -> list[int]:
    """1 for nodes all of whose text is content: they hold some, and nothing else but what is cut out inside."""
    own = [[0, 0] for _ in page.nodes]
    for k, text in page.blocks:
        for w in re.findall(r"\w+", text.lower()):
            own[k][w in content] += 1
    total = [list(x) for x in own]
    for k in range(len(page.nodes) - 1, 0, -1):
        for s in (0, 1):
            total[page.nodes[k].parent][s] += total[k][s]
    every = total[0][1]
    out = []
    for k, node in enumerate(page.nodes):
        if own[k][0] + own[k][1]:
            out.append(int(own[k][1] > own[k][0]))
        else:
            # A box without text of its own is content inside the smallest box that holds it all.
            smallest = total[k][1] == every and not any(total[c][1] == every for c in range(k + 1, len(page.nodes)) if page.nodes[c].parent == k)
            inside = node.parent >= 0 and out[node.parent] == 1
            out.append(int(total[k][1] > 0 and (not total[k][0] or smallest or inside)))
    return out


@lru_cache(maxsize=4)
def trained(n: int = LABELLED, rounds: int = ROUNDS) -> Weights:
    """Weights of greatest penalised likelihood on the labelled pages."""
    data = []
    for text, content in labelled_pages(n):
        page = parsed(text)
        y = np.array(node_labels(page, content), float)
        parents = [node.parent for node in page.nodes]
        pairs = np.zeros((2, 2))
        for k, p in enumerate(parents[1:], 1):
            pairs[int(y[p]), int(y[k])] += 1
        data.append((features(page), parents, y, pairs))
    total = sum(len(d[2]) for d in data)
    w, e = np.zeros(len(NAMES)), np.zeros((2, 2))
    square_w, square_e = np.full_like(w, 1e-8), np.full_like(e, 1e-8)
    for _ in range(rounds):
        gw, ge = -1e-4 * w * total, -1e-4 * e * total
        for x, parents, y, pairs in data:
            p, expected = marginals(parents, x @ w, e)
            gw += x.T @ (y - np.array(p))
            ge += pairs - expected
        gw, ge = gw / total, ge / total
        square_w = 0.9 * square_w + 0.1 * gw**2
        square_e = 0.9 * square_e + 0.1 * ge**2
        w = w + 0.1 * gw / (np.sqrt(square_w) + 1e-4)
        e = e + 0.1 * ge / (np.sqrt(square_e) + 1e-4)
    return Weights(w, e)


def main_text(text: str | None, weights: Weights) -> str:
    page = parsed(text or "")
    if not page.blocks:
        return ""
    p, _ = marginals([n.parent for n in page.nodes], features(page) @ weights.node, weights.edge)
    return "\n".join(t for k, t in page.blocks if p[k] >= 0.5)


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    weights = weights or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), weights) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    shape = "page_id long, url string, text string, n_chars long"
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, shape)
