"""Labelled pages to train the extractor on, written by rule.

A page is a random arrangement of an article and of what surrounds articles: menus, headers, footers,
sidebars, notices, adverts, forms, comments. Names of elements and classes vary, or are missing, so that the
model has to weigh them against text and order. Every block of text is generated with its label.
"""

from __future__ import annotations

import random
from html import escape

# Names that pages commonly give to their parts.
NAMES = {
    "article": "article post entry content story body main text article-body post-content entry-content page",
    "menu": "nav menu navbar navigation topnav main-menu breadcrumb breadcrumbs pagination tabs toc",
    "header": "header masthead banner topbar site-header page-header logo brand",
    "footer": "footer site-footer bottom copyright legal colophon page-footer",
    "sidebar": "sidebar side aside widget related related-posts recommended popular trending teaser more-stories",
    "notice": "notice cookie cookie-banner consent gdpr alert message popup modal overlay newsletter warning",
    "advert": "ad ads advert advertisement sponsor sponsored promo banner-ad promotion adsbygoogle",
    "form": "form search search-form login subscribe signup contact newsletter-form",
    "comments": "comments comment comment-list responses replies discussion disqus comment-body reply thread "
    "reviews user-reviews guestbook feedback remarks user-comments reader-comments",
    "share": "share social sharing tags meta byline author tools",
}
TAGS = {
    "article": "article main section div", "menu": "nav nav div ul", "header": "header header div",
    "footer": "footer footer div", "sidebar": "aside aside div section", "notice": "div section aside",
    "advert": "div aside ins section", "form": "form form div", "comments": "section div ol div",
    "share": "div ul div",
}
PHRASES = {
    "menu": "Home|About us|Contact|News|Sport|Products|Next|Previous|Archive|More",
    "header": "The Daily Page|Welcome to our site|Menu|Log in|Your trusted source",
    "footer": "© 2024 Example Media|All rights reserved.|Privacy policy|Terms of use|Imprint|© example.com · Contact",
    "sidebar": "Related articles|Most read|You may also like|Popular now|Read more",
    "notice": "We use cookies to improve this site.|Accept all|This site uses cookies. Accept|Please enable JavaScript.",
    "advert": "Advertisement|Sponsored|Buy now and save 50%|Special offer, limited time only!",
    "form": "Subscribe to our newsletter|Your e-mail|Search|Send|Password|Sign up",
    "comments": "Leave a comment|3 comments|Reply|Anna wrote on 3 May:|Report",
    "share": "Share on social media|Tags: one, two|Print|Posted in News",
}
# Words that stand in articles and around them alike, so that none of them speaks for either.
COMMON = "the a and of to in for on with this is it we you your all by more use site from not are at".split()
SYLLABLES = "an ar be con de di ent er es ge ha il in ka la lo ma men na ne ou per que ra re sa se ta ti to un ver vo".split()


class Writer:
    def __init__(self, seed: int):
        self.draw = random.Random(seed)
        self.blocks: list[tuple[str, int]] = []

    def words(self, low: int, high: int) -> str:
        draw = self.draw
        count = draw.randint(low, high)
        return " ".join(
            draw.choice(COMMON) if draw.random() < 0.25 else "".join(draw.choices(SYLLABLES, k=draw.choice((1, 2, 2, 3))))
            for _ in range(count)
        )

    def prose(self, sentences: int) -> str:
        parts = []
        for _ in range(sentences):
            words = self.words(1, 18).split(" ")
            if len(words) > 5 and self.draw.random() < 0.5:
                words[len(words) // 2] += ","
            parts.append(" ".join(words).capitalize() + self.draw.choice("...?!"))
        text = " ".join(parts)
        style = self.draw.random()
        if style < 0.04:
            return text.upper()
        if style < 0.08:
            return " | ".join(text.split(" "))
        if style < 0.12:
            return " ".join(w + self.draw.choice(("###", "%%%", "&&&", "***")) for w in text.split(" "))
        return text

    def block(self, text: str, label: int, tag: str = "p", inside: str = "") -> str:
        self.blocks.append((" ".join(text.split()), label))
        body = escape(text, quote=False)
        if inside == "link":  # a link on a word or two
            words = [escape(w, quote=False) for w in text.split(" ")]
            at = self.draw.randrange(len(words))
            body = " ".join([*words[:at], f'<a href="/y">{" ".join(words[at : at + 2])}</a>', *words[at + 2 :]])
        elif inside:
            body = f"<{inside}>{body}</{inside.split(' ')[0]}>"
        return f"<{tag}>{body}</{tag}>" if tag else body

    def element(self, role: str, body: str, named: float = 0.75) -> str:
        draw = self.draw
        tag = draw.choice(TAGS[role].split())
        if draw.random() < named or tag == "div":
            name = draw.choice(NAMES[role].split())
            kind = draw.choice(("class", "class", "id"))
            return f'<{tag} {kind}="{name}">{body}</{tag}>'
        return f"<{tag}>{body}</{tag}>"

    def phrase(self, role: str) -> str:
        if self.draw.random() < 0.5:
            return self.draw.choice(PHRASES[role].split("|"))
        return self.words(1, 4)

    def around(self, role: str) -> str:
        """One part that is not the article."""
        draw = self.draw
        if role in ("menu", "sidebar", "share") and draw.random() < 0.75:
            items = "".join(
                self.block(self.phrase(role), 0, "li", 'a href="/x"') for _ in range(draw.randint(2, 7))
            )
            body = f"<ul>{items}</ul>"
            if role == "sidebar" and draw.random() < 0.6:
                body = self_first(self, body, role)
        elif role == "form":
            body = self.block(self.phrase(role), 0, "label") + '<input name="q">' + self.block("Send", 0, "button")
        elif role == "comments":
            body = ""
            if draw.random() < 0.7:
                body += self.block(self.phrase(role), 0, "h3")
            for _ in range(draw.randint(1, 5)):
                inner = self.block(self.prose(draw.randint(1, 4)), 0, draw.choice(("p", "p", "div")))
                body += draw.choice((f"<li>{inner}</li>", f'<div class="comment">{inner}</div>', inner))
        elif role == "footer":
            body = self.block(f"{self.phrase(role)} · {self.prose(1)}", 0, draw.choice(("", "p", "div")))
        elif role == "header":
            body = self.block(self.phrase(role), 0, draw.choice(("h1", "div", "p", "h2")))
            if draw.random() < 0.4:
                body += self.block(self.prose(1), 0, "p")
        else:
            text = self.phrase(role) if draw.random() < 0.5 else self.prose(draw.randint(1, 3))
            body = self.block(text, 0, draw.choice(("", "", "p", "div")))
        return self.element(role, body, named=0.95 if role in ("notice", "advert", "share") else 0.75)

    def article(self) -> str:
        draw = self.draw
        body = self.block(self.words(3, 12).capitalize(), 1, draw.choice(("h1", "h1", "h2"))) if draw.random() < 0.85 else ""
        paragraph = "div" if draw.random() < 0.12 else "p"  # some pages know no paragraphs
        for _ in range(draw.randint(1, 14)):
            kind = draw.random()
            if kind < 0.72:
                body += self.block(self.prose(draw.choice((1, 1, 2, 4, 7))), 1, paragraph, draw.choice(("", "", "", "b", "em", "link")))
            elif kind < 0.80:
                body += self.block(self.words(1, 6).capitalize(), 1, draw.choice(("h2", "h3")))
            elif kind < 0.87:
                items = "".join(self.block(self.words(2, 12), 1, "li") for _ in range(draw.randint(2, 4)))
                body += f"<{(kind_ := draw.choice(('ul', 'ol')))}>{items}</{kind_}>"
            elif kind < 0.91:
                body += f"<blockquote>{self.block(self.prose(2), 1, 'p')}</blockquote>"
            elif kind < 0.94:
                cells = "".join(self.block(self.words(1, 3), 1, "td") for _ in range(3))
                body += f"<table><tr>{cells}</tr></table>"
            else:
                body += self.around(draw.choice(("advert", "advert", "notice", "share", "sidebar", "form")))
        bare = draw.random()
        if bare < 0.15:
            return body  # an article without an element of its own
        if bare < 0.22:
            return f"<div>{body}</div>"
        return self.element("article", body, named=0.6)

    def page(self) -> str:
        draw = self.draw
        head = f"<html><head><title>{escape(self.words(2, 5))}</title><script>x()</script></head><body>"
        before = [r for r in ("header", "menu", "notice", "advert", "form", "sidebar") if draw.random() < 0.45]
        after = [r for r in ("share", "sidebar", "comments", "advert", "form", "menu", "footer", "notice") if draw.random() < 0.45]
        draw.shuffle(before)
        bare = draw.random()  # some pages hold an article and little else
        if bare < 0.25:
            before = before[:0] if bare < 0.2 else before
            after = after[:0] if bare > 0.1 else after
        body = "".join(self.around(r) for r in before) + self.article() + "".join(self.around(r) for r in after)
        if draw.random() < 0.25:
            body = f'<div class="{draw.choice(("wrapper", "container", "page", "row", "col", "inner"))}">{body}</div>'
        return head + body + "</body></html>"


def self_first(writer: Writer, body: str, role: str) -> str:
    """A heading before a list that is already written: its label goes before the list's labels."""
    count = body.count("<li>")
    listed = writer.blocks[-count:]
    del writer.blocks[-count:]
    heading = writer.block(writer.phrase(role), 0, "h3")
    writer.blocks += listed
    return heading + body


def labelled_pages(count: int, seed: int = 1) -> list[tuple[str, list[tuple[str, int]]]]:
    """(html, [(block text, 1 if main text)]) of generated pages."""
    pages = []
    for number in range(count):
        writer = Writer(seed * 1_000_003 + number)
        html = writer.page()
        pages.append((html, writer.blocks))
    return pages
