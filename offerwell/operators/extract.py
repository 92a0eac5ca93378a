"""Shop pages to listing rows.

Python only walks the page tree and returns raw texts, Arrow batch by Arrow batch; prices, ratings, badges, sellers and
links are read from those texts with native columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from offerwell import constants as K
from offerwell.functions import offers as O
from offerwell.functions import text as T
from offerwell.operators.dedup import keep_first

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Elements whose end tag may be left out, and the open elements that their start ends.
_IMPLIED = {
    "li": {"li"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"},
}
_STEP = re.compile(r"\s*(>?)\s*([a-zA-Z][\w-]*)?((?:[.#][\w-]+|\[[^\]]+\])*)")


# The start tag, end tag or text that the quick reader knows, and elements whose content is read by rules of its own.
_PLAIN = re.compile(r'(<([a-z][a-z0-9]*)((?: [a-z][a-z0-9-]*="[^"<>&]*")*)>|</([a-z][a-z0-9]*)>|([^<]+))')
_ATTRIBUTE = re.compile(r' ([a-z][a-z0-9-]*)="([^"]*)"')
_OWN_RULES = frozenset("script style textarea title iframe noembed noframes noscript xmp plaintext svg math".split())


class _Node:
    __slots__ = ("tag", "attrs", "parent", "children", "classes", "depth", "every", "place")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        self.classes = attrs["class"].split() if "class" in attrs else ()
        if parent is None:
            self.depth, self.every = 0, []
        else:
            self.depth, self.every = parent.depth + 1, parent.every
        self.place = len(self.every)
        self.every.append(self)  # elements open in page order, so those below one follow it

    def walk(self) -> list[_Node]:
        """All elements below this one in page order."""
        every, depth, end = self.every, self.depth, self.place + 1
        if not depth:
            return every[1:]
        while end < len(every) and every[end].depth > depth:
            end += 1
        return every[self.place + 1 : end]

    def texts(self) -> Iterator[str]:
        stack = self.children[::-1]
        while stack:
            c = stack.pop()
            if not isinstance(c, _Node):
                yield c
            elif c.tag not in ("script", "style"):
                stack.extend(reversed(c.children))


class _Page(HTMLParser):
    """Page tree; an end tag closes the nearest open element of its name."""

    def __init__(self, html: str):
        self.root = self.at = _Node("", {}, None)
        if not self._quick(html):
            super().__init__(convert_charrefs=True)
            self.root = self.at = _Node("", {}, None)
            self.feed(html)
            self.close()

    def _quick(self, html: str) -> bool:
        """Read a page of plain tags, quoted attributes and texts without references; false when it holds anything else.

        The tree is that of the full parser, which takes most of the time of a page.
        """
        if "&" in html:
            return False
        upto, at = 0, self.at
        for whole, tag, attrs, end, text in _PLAIN.findall(html):
            upto += len(whole)
            if text:
                at.children.append(text)
            elif end:
                if at.tag == end:
                    at = at.parent
                else:
                    self.at = at
                    self.handle_endtag(end)
                    at = self.at
            elif tag in _OWN_RULES:
                return False
            else:
                if at.tag in _IMPLIED.get(tag, ()):
                    at = at.parent
                node = _Node(tag, dict(_ATTRIBUTE.findall(attrs)) if attrs else {}, at)
                at.children.append(node)
                if tag not in _VOID:
                    at = node
        return upto == len(html)  # what is skipped between two finds is missing here

    def handle_starttag(self, tag, attrs):
        self._open(tag, {k: v or "" for k, v in attrs})

    def _open(self, tag: str, attrs: dict):
        ends = _IMPLIED.get(tag)
        if ends and self.at.tag in ends:  # such an element ends where the next one of its kind begins
            self.at = self.at.parent
        node = _Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


@lru_cache(maxsize=512)
def _compile(selector: str):
    """Steps of a selector: (direct child?, tag, classes, attribute tests) from left to right."""
    steps = []
    for m in _STEP.finditer(selector):
        if not m.group(0).strip():
            continue
        marks = re.findall(r"[.#][\w-]+|\[[^\]]+\]", m.group(3))
        classes = [x[1:] for x in marks if x[0] == "."]
        tests = [("id", "=", x[1:]) for x in marks if x[0] == "#"]
        for x in (x for x in marks if x[0] == "["):
            name, op, value = re.match(r"\[([\w-]+)(?:([*]?=)['\"]?([^'\"\]]*)['\"]?)?\]", x).groups()
            tests.append((name, op or "", value or ""))
        steps.append((m.group(1) == ">", m.group(2), classes, tests))
    return steps


def _fits(node: _Node, step) -> bool:
    _, tag, classes, tests = step
    if tag and node.tag != tag:
        return False
    for c in classes:
        if c not in node.classes:
            return False
    for name, op, value in tests:
        have = node.attrs.get(name)
        if have is None or (op == "=" and have != value) or (op == "*=" and value not in have):
            return False
    return True


def _matches(node: _Node, steps, top: _Node) -> bool:
    if not _fits(node, steps[-1]):
        return False
    if len(steps) == 1:
        return True
    up = node.parent
    while up is not None and up is not top.parent:
        if _matches(up, steps[:-1], top):
            return True
        if steps[-1][0]:
            return False
        up = up.parent
    return False


def _select(top: _Node, selector: str, below: list[_Node] | None = None) -> list[_Node]:
    """Elements below ``top`` that fit; ``below`` are all of them, for several selectors."""
    steps = _compile(selector)
    found = top.walk() if below is None else below
    _, tag, classes, tests = steps[-1]
    if tag:
        found = [n for n in found if n.tag == tag]
    for c in classes:
        found = [n for n in found if c in n.classes]
    if tests or len(steps) > 1:
        found = [n for n in found if _matches(n, steps, top)]
    return found


def _value(card: _Node, below: list[_Node], selectors: Sequence[str]) -> str:
    """Text or attribute (``selector@name``) of the first selector that finds an element; ``+`` joins all matches."""
    for s in selectors:
        path, _, attr = s.partition("@")
        every = path.endswith("+")
        found = [card] if path == "" else _select(card, path.rstrip("+"), below)
        if found:
            if attr and (attr != "style" or "width" in found[0].attrs.get(attr, "")):
                return found[0].attrs.get(attr, "")
            texts = ["".join(t.strip() for t in n.texts()) for n in (found if every else found[:1])]
            return " ".join(texts)
    return ""


@dataclass(frozen=True)
class CardRules:
    """Selectors of one shop, tried in order: card containers, then the fields inside a card."""

    cards: tuple[str, ...]
    title: tuple[str, ...]
    link: tuple[str, ...] = ()
    price_new: tuple[str, ...] = ()
    price_old: tuple[str, ...] = ()
    badge: tuple[str, ...] = ()
    rating: tuple[str, ...] = ()
    seller: tuple[str, ...] = ()
    location: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    base_url: str = ""
    source: str = ""
    currency: str = "EUR"
    # How the rating text is read: "width" (CSS percent), "out_of" (N sur 5), "width_or_text" or "text".
    rating_form: str = "text"
    defaults: dict = field(default_factory=dict)


# Page selectors of the supported shops.
CARD_RULES = {
    "jumia": CardRules(
        cards=("article.prd",), title=("h3.name", ".name"), link=("a.core@href",), price_new=("div.prc",),
        price_old=("div.old",), badge=(".bdg._dsct", "[class*='dsct']"), rating=(".stars._s@style",),
        seller=(".aut", "[class*='aut']", ".shps"), location=(".loc", "[class*='loc']"),
        base_url="https://www.jumia.ma", source="Jumia", currency="MAD", rating_form="width", defaults={"location": "Maroc"},
    ),
    "amazon": CardRules(
        cards=(
            "div[data-component-type='s-search-result']", "div[data-asin][data-index]", ".s-result-item[data-asin]",
        ),
        title=(
            "h2 span.a-text-normal", "[data-cy='title-recipe'] span", ".a-size-medium.a-color-base.a-text-normal",
            "h2 span",
        ),
        link=("h2 a.a-link-normal@href", "a[href*='/dp/']@href"),
        price_new=("span.a-price > span.a-offscreen",), price_old=("span.a-price.a-text-price > span.a-offscreen",),
        badge=(".s-coupon-highlight-color", ".a-badge-label", "[class*='deal']"),
        rating=("span[aria-label*='étoile']@aria-label", "span.a-icon-alt"),
        seller=(".a-size-base.s-underline-text", "[data-csa-c-slot-id*='brand']"), key=("@data-asin",),
        base_url="https://www.amazon.fr", source="Amazon", rating_form="out_of", defaults={"location": "Amazon.fr"},
    ),
    "amazon_deals": CardRules(
        cards=("[data-asin]", "div[class*='ProductCard-module__card']"),
        title=("span.a-truncate-full", "[class*='ProductCard-module__title']", "h2 span", "p span", "p"),
        link=("a[href*='/dp/']@href", "a[href]@href"),
        price_new=(
            "[data-testid='price-section'] .a-price .a-offscreen", "span.a-price > span.a-offscreen",
            ".a-price .a-offscreen", "span.a-price",
        ),
        price_old=("span.a-text-price > span.a-offscreen", "span.a-text-price", ".a-text-strike"),
        badge=("[class*='filledRoundedBadgeLabel']", "[class*='BadgeLabel']", "span.a-badge-label"),
        rating=("span[aria-label*='étoile']@aria-label", "span[aria-label*='star']@aria-label", "span.a-icon-alt"),
        key=("@data-asin",), base_url="https://www.amazon.fr", source="AmazonDeals",
        rating_form="out_of", defaults={"location": "Amazon.fr"},
    ),
    "avito": CardRules(
        cards=("a.sc-1jge648-0",), title=("p.sc-1x0vz2r-0.iHApav",), link=("@href",),
        price_new=("span.sc-3286ebc5-2",), price_old=("span.sc-3286ebc5-3",),
        badge=(".sc-3286ebc5-5", "[class*='discount']"), rating=(".sc-iHGNWf@style", "[class*='rating']"),
        seller=("p.sc-1x0vz2r-0.hNCqYw",), location=("p.sc-1x0vz2r-0.layWaX",),
        base_url="https://www.avito.ma", source="Avito", currency="MAD", rating_form="width_or_text",
    ),
    "steam": CardRules(
        cards=("#search_resultsRows a.search_result_row",), title=("span.title",), link=("@href",),
        price_new=(".discount_final_price", ".search_price"), price_old=(".discount_original_price",),
        badge=(".discount_pct",), rating=(".search_review_summary@data-tooltip-html",), key=("@data-ds-appid",),
        base_url="https://store.steampowered.com", source="Steam", defaults={"seller": "Valve", "location": "Steam"},
    ),
    "electroplanet": CardRules(
        cards=("li.item.product.product-item",), title=("a.product-item-link span+", "a.product-item-link"),
        link=("a.product-item-link@href",), price_new=(".special-price .price", ".price-wrapper .price"),
        price_old=(".old-price .price",), seller=("a.product-item-link span",),
        base_url="https://www.electroplanet.ma", source="Electroplanet", currency="MAD",
        defaults={"location": "Electroplanet.ma", "seller": "Electroplanet"},
    ),
}
_FIELDS = ["title", "link", "price_new", "price_old", "badge", "rating", "seller", "location", "key"]


_CARD = [("page_id", pa.int64()), ("position", pa.int32())]


def _batch(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema])


def card_texts(pages: DataFrame, rules: CardRules) -> DataFrame:
    """Raw texts of every titled card: (page_id, position, title, link, price_new, ...)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, html in zip(*(batch.column(k).to_pylist() for k in range(2))):
                root = _Page(html or "").root
                every = root.walk()
                cards = next((found for s in rules.cards if (found := _select(root, s, every))), [])
                for position, card in enumerate(cards):
                    below = card.walk()
                    values = [_value(card, below, getattr(rules, f)) for f in _FIELDS]
                    if values[0]:
                        out.append((page_id, position, *values))
            yield _batch(out, schema)

    schema = _CARD + [(f, pa.string()) for f in _FIELDS]
    return pages.select(F.col("page_id").cast("bigint"), "html").mapInArrow(cut, from_arrow_schema(pa.schema(schema)))


def extract_cards(pages: DataFrame, rules: CardRules) -> DataFrame:
    """Listing rows of the cards of every page, in the numeric naming convention."""
    label = "(?i)(?:deal|lowest|price|list):\\s*"
    new = T.clean_text(F.regexp_replace("price_new", label, ""))
    old = T.clean_text(F.regexp_replace("price_old", label, ""))
    store = rules.source == "Steam"
    p1 = T.parse_store_price(F.nullif(new, F.lit(""))) if store else T.price_to_float(new)
    p0 = T.parse_store_price(F.nullif(old, F.lit(""))) if store else T.price_to_float(old)
    if rules.source == "Electroplanet":
        p0 = F.coalesce(p0, p1)
    stars = F.regexp_replace("rating", "<[^>]*>", " ")
    width = F.regexp_extract(stars, r"width:\s*(\d+(?:\.\d+)?)", 1)
    out_of = F.regexp_extract(stars, r"(?i)([\d,.]+)\s*(?:sur|étoile|star|out)", 1)
    percent = F.when(width != "", F.concat(width, F.lit("%")))
    note = {
        "width": F.coalesce(percent, F.lit("")),
        "width_or_text": F.coalesce(percent, T.clean_text(stars)),
        "out_of": F.replace(out_of, F.lit(","), F.lit(".")),
        "text": T.clean_text(stars),
    }[rules.rating_form]
    raw_link = F.col("link")
    link = F.when(raw_link.startswith("http"), raw_link).otherwise(F.concat(F.lit(rules.base_url), raw_link))
    texts = card_texts(pages, rules)
    if rules.source.startswith("Amazon"):
        item = F.regexp_extract("link", r"/dp/([A-Z0-9]{10})", 1)
        texts = texts.withColumn("key", F.coalesce(F.nullif(F.trim("key"), F.lit("")), item)).where("key <> ''")
        link = F.when(item != "", F.concat(F.lit(rules.base_url + "/dp/"), item)).otherwise(link)
    if rules.source == "AmazonDeals":
        texts = texts.where(F.length("title") >= 5)
    if store:
        link = T.canonical_link(raw_link, rules.base_url)
    rows = texts.withColumns(
        {
            "prixInitial": p0,
            "prixOffre": p1,
            "prixBase": F.coalesce(p0, p1) if store else F.coalesce(F.when(p1 != 0, p1), p0),
            "lien": F.when(raw_link != "", link).otherwise(F.lit("")),
            "note": note,
        }
    )
    # A column of its own, so that its two fields are not computed twice.
    rows = rows.withColumn("offer", O.badge_to_offer(F.col("badge"), F.col("prixInitial"), F.col("prixOffre"), O.BADGE_RULES[rules.source]))
    offer = F.col("offer")

    def default(name: str) -> Column:
        return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(rules.defaults.get(name, "")))

    return rows.select(
        "page_id",
        "position",
        "key",
        F.col("title").alias("titre"),
        "prixInitial",
        "prixBase",
        "prixOffre",
        default("location").alias("location"),
        F.lit(rules.currency).alias("monnaie"),
        offer["type_offre"].alias("typeOffre"),
        offer["valeur"].alias("valeurOffre"),
        default("seller").alias("seller"),
        F.col("note").alias("rating"),
        F.col("lien").alias("link"),
    )


_CONTAINER_WORDS = ("ProductBlock", "prd", "card", "product")
_MAX_TEXTS = 60


def _container(a: _Node) -> _Node:
    """Closest list item, else article, else product-like block; the anchor itself when that is too large."""

    def closest(test):
        up = a.parent
        while up is not None and not test(up):
            up = up.parent
        return up

    box = (
        closest(lambda n: n.tag == "li")
        or closest(lambda n: n.tag == "article")
        or closest(lambda n: n.tag == "div" and any(w in n.attrs.get("class", "") for w in _CONTAINER_WORDS))
    )
    return a if box is None or sum(1 for t in box.texts() if t.strip()) > _MAX_TEXTS else box


def _title(box: _Node) -> str:
    for n in box.walk():
        if n.tag in ("h2", "h3", "h4"):
            text = "".join(t.strip() for t in n.texts())
            if len(text) > 5:
                return text
    alt = next((n.attrs.get("alt", "").strip() for n in box.walk() if n.tag == "img"), "")
    return alt if len(alt) > 5 else ""


def extract_cards_heuristic(pages: DataFrame, base_url: str, site: str, skip: Sequence[str] = K.SKIP_LINK_WORDS):
    """Listing rows without class names: product anchors, their enclosing container and its texts.

    Titles are at least eight characters and not navigation words; a link counts once per page.
    """
    skip = list(skip)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, html in zip(*(batch.column(k).to_pylist() for k in range(2))):
                anchors = [n for n in _Page(html or "").root.walk() if n.tag == "a" and "href" in n.attrs]
                for position, a in enumerate(anchors):
                    href = a.attrs["href"]
                    if ".html" not in href or any(w in href for w in skip):
                        continue
                    box = _container(a)
                    title = _title(box)
                    if len(title) >= 8 and title.lower() not in K.GENERIC_TITLES:
                        aria = next(
                            (n.attrs["aria-label"] for n in box.walk() if "étoile" in n.attrs.get("aria-label", "").lower()),
                            "",
                        )
                        nodes = [t.strip() for t in box.texts() if t.strip()]
                        out.append((page_id, position, href, title, nodes, aria))
            yield _batch(out, schema)

    schema = _CARD + [("href", pa.string()), ("title", pa.string()), ("nodes", pa.list_(pa.string())), ("aria", pa.string())]
    rows = pages.select(F.col("page_id").cast("bigint"), "html").mapInArrow(cut, from_arrow_schema(pa.schema(schema)))
    nodes = F.col("nodes")
    prices = O.pick_prices(nodes)
    rows = rows.withColumns(
        {
            "link": T.canonical_link(F.col("href"), base_url),
            **prices,
            "badge": O.pick_badge(nodes),
            "rating": O.pick_rating(nodes, F.col("aria")),
            "seller": O.pick_seller(nodes, F.col("title"), "Cdiscount"),
        }
    ).where(F.col("link").contains(site) & F.col("price_new").isNotNull())
    rows = keep_first(rows, ["page_id", "link"], ["position"])
    offer = O.badge_to_offer(
        F.col("badge"), T.price_to_float(F.col("price_old")), T.price_to_float(F.col("price_new")),
        O.BADGE_RULES["CDiscount"],
    )
    return rows.select(
        "page_id",
        "title",
        F.col("price_old").alias("price_initial"),
        F.col("price_new").alias("price_offre"),
        "rating",
        "seller",
        "link",
        offer["type_offre"].alias("type_offre"),
        offer["valeur"].alias("valeur"),
    )


def product_links(pages: DataFrame, must_contain: str = ".html", skip: Sequence[str] = K.SKIP_LINK_WORDS) -> DataFrame:
    """Anchors that point to products: (page_id, href)."""
    hrefs = F.regexp_extract_all("html", F.lit(r'(?is)<a\s[^>]*?href="([^"]*)"'), 1)
    rows = pages.select("page_id", F.explode(hrefs).alias("href")).where(F.col("href").contains(must_contain))
    for word in skip:
        rows = rows.where(~F.col("href").contains(word))
    return rows


def flag_blocked(pages: DataFrame, markers: Sequence[str] = K.BLOCK_MARKERS) -> DataFrame:
    """True when the page text holds a bot-check marker."""
    low = F.lower("html")
    found = F.lit(False)
    for m in markers:
        found = found | low.contains(m)
    return pages.withColumn("is_blocked", found)


def page_profile(pages: DataFrame, pattern: str, k: int, keywords: Sequence[str] = K.PROFILE_KEYWORDS) -> DataFrame:
    """Top-k tokens of a pattern (first 50 characters), keyword hits and price-pattern hits over all pages."""
    tokens = pages.select(F.explode(F.regexp_extract_all("html", F.lit(pattern), 1)).alias("t"))
    words = tokens.select(F.explode(F.split("t", r"\s+")).alias("w")).where("w <> ''")
    top = words.groupBy(F.substring("w", 1, 50).alias("item")).agg(F.count("*").alias("n"))
    top = top.orderBy(F.desc("n"), "item").limit(k).select(F.lit("token").alias("kind"), "item", "n")
    hits = {w: F.regexp_count("html", F.lit(re.escape(w))) for w in keywords}
    hits["price"] = F.regexp_count("html", F.lit(r"€\s*[\d,.]+"))
    counts = pages.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(w) for w, c in hits.items()])
    return top.unionByName(
        counts.unpivot([], list(hits), "item", "n").select(F.lit("keyword").alias("kind"), "item", "n")
    )
