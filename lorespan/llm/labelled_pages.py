"""Labelled pages for training the extraction: varied layouts, with content marked block by block.

Pages are drawn from a seeded generator, so training gives the same weights everywhere. Content is marked in the
markup by the attribute ``data-keep`` on the innermost block, which no feature reads.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

from lorespan.llm.dom import Block, leaf_blocks

KEEP = "⁣"  # an invisible separator that starts the text of every content block of a labelled page
_SYLLABLES = "ka lo mi ter an os ver un el dra in po sa re ti on qu ma ne ri".split()


class _Writer:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(_SYLLABLES, k=self.r.choice((1, 1, 2, 2, 3))))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 3, high: int = 14) -> str:
        return self.words(low, high).capitalize() + self.r.choice("....!?")

    def paragraph(self) -> str:
        kind = self.r.random()
        if kind < 0.15:
            return self.sentence(1, 3)
        text = " ".join(self.sentence() for _ in range(self.r.randint(1, 12)))
        if kind > 0.93:
            text = " ".join(w + self.r.choice(("***", "%%%", "&amp;&amp;", "!!")) for w in text.split())
        elif kind > 0.88:
            text = " | ".join(text.split())
        elif kind > 0.84:
            text = text.upper()
        return text

    def tag(self, name: str, text: str, kind: str = "", keep: bool = False) -> str:
        return f"<{name}{f' class={chr(34)}{kind}{chr(34)}' if kind else ''}>{KEEP if keep else ''}{text}</{name}>"

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.words(1, 3)}</a></li>' for _ in range(self.r.randint(low, high)))

    def content(self) -> str:
        r, out = self.r, []
        for k in range(r.randint(0, 9)):
            kind = r.random()
            if kind < 0.72:
                text = self.paragraph()
                if r.random() < 0.15:
                    text += f' <a href="/{self.word()}">{self.words(1, 4)}</a> ' + self.sentence()
                out.append(f"<p>{KEEP}<b>{text}<br>" if r.random() < 0.1 else self.tag("p", text, keep=True))
            elif kind < 0.80:
                out.append(self.tag(r.choice(("h2", "h3")), self.words(1, 7).capitalize(), keep=True))
            elif kind < 0.86:
                out.append(self.tag(r.choice(("ul", "ol")), "".join(self.tag("li", self.words(2, 15), keep=True) for _ in range(r.randint(2, 5)))))
            elif kind < 0.90:
                out.append(self.tag("blockquote", self.tag("p", self.sentence(), keep=True)))
            elif kind < 0.93:
                cells = "".join(self.tag("td", self.words(1, 3), keep=True) for _ in range(r.randint(2, 4)))
                out.append(f"<table><tr>{cells}</tr></table>")
            elif kind < 0.95:
                out.append(self.tag("pre", self.words(3, 20), keep=True))
            elif kind < 0.97:
                out.append(f"<figure><img src='x.png'>{self.tag('figcaption', self.sentence(), keep=True)}</figure>")
            else:
                out.append(self.intruder())
        return "".join(out)

    def intruder(self) -> str:
        """What stands inside an article but is no part of it."""
        kinds = ("ad", "advert", "ads banner", "sponsored promo", "share social", "related", "newsletter subscribe", "notice", "cookie consent", "author-box", "tags", "toc menu")
        body = self.r.choice((self.paragraph(), f"<ul>{self.links(2, 4)}</ul>", f"<p>{self.sentence()}</p>"))
        return self.r.choice((f'<div class="{self.r.choice(kinds)}">{body}</div>', f"<aside>{body}</aside>", self.form()))

    def form(self) -> str:
        return f"<form><label>{self.words(1, 4)}</label><input name=q><button>{self.words(1, 2)}</button><p>{self.sentence()}</p></form>"

    def comments(self) -> str:
        one = lambda: f'<li class="comment"><p>{self.paragraph()}</p></li>'
        body = "".join(one() for _ in range(self.r.randint(1, 5)))
        place = self.r.choice(('<section id="comments">', '<div class="comments">', '<section class="comment-list discussion">', '<div class="reader-comments replies">'))
        end = "</section>" if place.startswith("<section") else "</div>"
        return f"{place}<h3>{self.words(1, 2).capitalize()}</h3><ul>{body}</ul>{self.form() if self.r.random() < 0.3 else ''}{end}"

    def page(self) -> str:
        r = self.r
        title = self.words(2, 10).capitalize() + r.choice((".", "", "."))
        heading = self.tag("h1", title, keep=True)
        lead = f"<p>{KEEP}<b>{title} {self.paragraph()}<br>" if r.random() < 0.4 else ""
        body = heading + lead + self.content()
        if r.random() < 0.1:
            body = self.tag("p", self.paragraph(), keep=True) + self.content()
        elif r.random() < 0.15:
            body = f"<header>{heading}<p class=\"byline meta\">{self.words(2, 5)}</p></header>" + body[len(heading):]
        style = r.random()
        if style < 0.45:
            main = f"<article>{body}</article>"
        elif style < 0.65:
            main = f"<main>{body}</main>" if r.random() < 0.4 else f"<main><article class=\"{r.choice(('post', 'entry', 'story'))}\">{body}</article></main>"
        else:
            kind = r.choice(("content", "article-body", "post-content", "entry", "main-text", "story", "post"))
            place = r.choice(("class", "id"))
            main = f'<div {place}="{kind}">{body}</div>'
        top, bottom = [], []
        if r.random() < 0.85:
            top.append(r.choice((f"<nav><ul>{self.links(3, 8)}</ul></nav>", f'<div class="{r.choice(("menu", "navbar", "navigation top"))}"><ul>{self.links(3, 8)}</ul></div>')))
        if r.random() < 0.3:
            top.insert(0, f"<header>{self.tag('div', self.words(1, 3), 'logo')}<p>{self.sentence()}</p></header>")
        if r.random() < 0.3:
            top.append(f'<div class="{r.choice(("cookie-notice", "notice alert", "consent banner", "notice"))}"><p>{self.sentence()} {self.sentence()}</p></div>')
        extras = [
            lambda: f'<div class="{r.choice(("ad", "advert", "ads", "sponsor", "banner promo"))}">{self.paragraph()}</div>',
            lambda: f'<{(t := r.choice(("aside", "div")))} class="{r.choice(("sidebar", "widget", "side column"))}"><h3>{self.words(1, 3)}</h3><p>{self.paragraph()}</p><ul>{self.links(2, 5)}</ul></{t}>',
            lambda: f"<aside><p>{self.paragraph()}</p></aside>",
            lambda: self.form(),
            lambda: f'<div class="{r.choice(("related", "share-links social", "breadcrumb", "pagination", "newsletter"))}"><ul>{self.links(2, 5)}</ul></div>',
        ]
        for extra in extras:
            if r.random() < 0.35:
                (top if r.random() < 0.5 else bottom).append(extra())
        if r.random() < 0.4:
            if style < 0.65 and r.random() < 0.3:
                main = main.replace("</article>", self.comments() + "</article>", 1)
            else:
                bottom.insert(0, self.comments())
        if r.random() < 0.9:
            foot = f"&copy; {self.word()}.example &middot; {self.sentence()}"
            bottom.append(r.choice((f"<footer>{foot}</footer>", f"<footer><p>{foot}</p></footer>", f'<div class="footer">{foot}</div>', f'<div id="page-footer">{self.paragraph()}</div>')))
        if r.random() < 0.08:
            top, bottom = [], []
        elif r.random() < 0.1:
            bottom = []  # a page that was cut off
        return f"<html><head><title>{title}</title></head><body>{''.join(top)}{main}{''.join(bottom)}</body></html>"


def labelled_page(seed: int) -> str:
    return _Writer(seed).page()


def labelled_pages(n: int, first: int = 0) -> Iterator[tuple[list[Block], list[bool]]]:
    """Blocks of ``n`` pages and whether each is content."""
    for seed in range(first, first + n):
        blocks, labels = [], []
        for block in leaf_blocks(labelled_page(seed)):
            labels.append(KEEP in block.text)
            block.text = block.text.replace(KEEP, "")
            if block.text:
                blocks.append(block)
            else:
                labels.pop()
        yield blocks, labels
