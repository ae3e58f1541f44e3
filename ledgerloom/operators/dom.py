"""Elements of HTML pages: a token stream with nesting depth, and the texts and facts read from it.

A page's markup is cut into tags and the text after each (``pieces``). Tags become rows of (page, position,
tag, opening or closing); the running depth of a tag's opens and closes gives each element its level, and
the next close on that level is its end. Only positions are shuffled: the texts are put together from the
page's own pieces afterwards, so nested elements are taken apart without sending their texts twice.
A page is one row of the input, so the windows of a page are bounded by that row.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import page_values as v
from ledgerloom.functions import rules
from ledgerloom.functions.text import clean, col
from ledgerloom.operators.discovery import HIDDEN, decoded

TITLE = "(?is)<title[^>]*>.*?</title>"
PIECE = "(?s)<([^>]*)>([^<]*)"
NAME = "(?s)^(/?)\\s*([A-Za-z][A-Za-z0-9-]*)"
#: Elements that have no end.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]


def attribute(tag, name) -> Column:
    """Value of an attribute of a tag's inside, empty if it has none."""
    pattern = f"(?is)[\\s\"'/]{name}\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s\"'>]+))"
    return decoded(F.concat(*[F.regexp_extract(col(tag), pattern, i) for i in (1, 2, 3)]))


def _pieces(html) -> tuple[Column, Column]:
    """Insides of all tags, and the text after each; text before the first tag follows an empty one."""
    shown = F.concat(F.lit("<>"), F.regexp_replace(F.regexp_replace(F.coalesce(col(html), F.lit("")), TITLE, " "), HIDDEN, " "))
    return F.regexp_extract_all(shown, F.lit(PIECE), 1), F.regexp_extract_all(shown, F.lit(PIECE), 2)


def elements(pages: DataFrame, page="page_id", html="html") -> DataFrame:
    """(page, elements): every element with its tag, first and last piece, role, and the text it has without content.

    An element without an end reaches to the end of the page, a paragraph to the next one. ``page`` must tell the rows apart.
    """
    tokens = pages.select(page, F.posexplode(_pieces(html)[0]).alias("at", "inside")).select(
        page, "at", "inside", F.lower(F.regexp_extract("inside", NAME, 2)).alias("tag"), (F.regexp_extract("inside", NAME, 1) == "/").alias("closing")).filter("tag <> ''")
    kind = F.lower(attribute("inside", "type"))
    void = F.col("tag").isin(VOID) | F.rtrim("inside").endswith("/")
    role, classes = F.lower(attribute("inside", "role")), F.split(F.lower(attribute("inside", "class")), "\\s+")
    hidden = F.col("inside").rlike("(?is)[\\s\"'/]hidden(\\s|=|/|$)") | attribute("inside", "style").rlike(v.HIDDEN_STYLE) | ((F.col("tag") == "dialog") & ~F.col("inside").rlike("(?is)[\\s\"'/]open(\\s|=|/|$)"))
    clickable = ((F.col("tag") == "a") & (F.trim(attribute("inside", "href")) != "")) | F.col("tag").isin("button", "input") | (role == "button")
    has_class = lambda names: F.arrays_overlap(classes, F.array(*map(F.lit, names)))
    facts = tokens.filter(~F.col("tag").isin(VOID) | ((F.col("tag") == "input") & kind.isin("button", "submit"))).select(
        page, "at", "tag", "closing", void.alias("void"), (role == "button").alias("role_button"),
        F.when(F.col("tag").isin("button", "input"), attribute("inside", "value")).otherwise("").alias("value"), attribute("inside", "aria-label").alias("label"),
        (clickable & ~hidden).alias("clickable"),
        ((clickable | F.col("inside").rlike(v.PRODUCT_ATTRIBUTE) | has_class(v.CARD_CLASSES)) & ~hidden).alias("card"),
        (((F.col("tag") == "dialog") | (role == "dialog") | (F.lower(attribute("inside", "aria-modal")) == "true") | has_class(v.DIALOG_CLASSES)) & ~hidden).alias("dialog"))
    dealt = facts.repartition(page)
    of_tag = Window.partitionBy(page, "tag").orderBy("at")
    step = F.when(F.col("void"), 0).when(F.col("closing"), -1).otherwise(1)
    after = F.sum(step).over(of_tag.rowsBetween(Window.unboundedPreceding, 0))
    level = F.when(F.col("void"), F.lit(None)).when(F.col("tag") == "p", 1).otherwise(F.when(F.col("closing"), F.col("_after") + 1).otherwise(F.col("_after")))
    levels = dealt.withColumn("_after", after).withColumn("_level", level)
    next_ = F.lead("at").over(Window.partitionBy(page, "tag", "_level").orderBy("at"))
    found = levels.withColumn("_next", next_).filter("NOT closing").withColumn("end", F.when(F.col("void"), F.col("at")).otherwise(F.coalesce("_next", F.lit(1 << 30))))
    one = F.struct("at", "end", "tag", "role_button", "void", "clickable", "card", "dialog", F.coalesce(F.nullif("value", F.lit("")), "label").alias("instead"))
    return found.groupBy(page).agg(F.array_sort(F.collect_list(one)).alias("elements"))


def first_distinct(texts, limit: int) -> Column:
    """First ``limit`` texts that differ in more than case, empty ones left out, in order."""
    return _kept(F.filter(texts, lambda t: t != ""), limit)


def _kept(texts, limit):
    lowered = F.transform(texts, F.lower)
    return F.transform(F.slice(F.array_distinct(lowered), 1, limit), lambda k: F.element_at(texts, F.array_position(lowered, k).cast("int")))


def _ascii_words(pattern: str) -> str:
    """A pattern between two word boundaries, where only ASCII letters, digits and the underscore make words."""
    head, body, tail = pattern.split("\\b")
    return f"{head}(?<![A-Za-z0-9_]){body}(?![A-Za-z0-9_]){tail}"


#: Lists of texts: the elements they come from, a pattern the text must match, the most that are kept.
LISTS = {
    "heading_texts": (["h1", "h2", "h3"], None, 20), "button_texts": (["button", "input"], None, 30), "link_texts": (["a"], None, 30), "label_texts": (["label"], None, 20),
    "ar_text_hints": (["a", "button", "span", "div", "[role]"], _ascii_words(v.AR_PATTERN), 20), "rotate_text_hints": (["a", "button", "span", "div", "[role]"], _ascii_words(v.ROTATE_PATTERN), 20),
}
BLOCKS = ["h1", "h2", "h3", "p", "li", "label", "button", "a", "span", "div"]
BLOCK_LENGTH, MOST_BLOCKS = 12, 40


def element_texts(pages: DataFrame, page="page_id", html="html") -> DataFrame:
    """``pages`` with the lists of ``LISTS``; ``text_block_count``: different texts of 12 or more characters, 40 at most; and of
    elements that their own markup does not hide: dialogs, clickable ones, product cards (with an image and a text), and
    ``cta_texts``, the first 30 texts of clickable ones."""
    names = pages.columns
    pieces = F.transform(_pieces(html)[1], decoded)
    rows = pages.join(elements(pages.select(page, html), page, html), page, "left").withColumn("_pieces", pieces)
    content = lambda e: F.when(e.void, "").otherwise(clean(F.array_join(F.slice("_pieces", e.at + 1, F.greatest(F.least(e.end, F.size("_pieces")) - e.at, F.lit(0))), " ")))
    media = F.array_compact(F.transform(_pieces(html)[0], lambda tag, i: F.when(tag.rlike("(?i)^(img|picture|svg|canvas)\\b"), i)))
    texts = F.transform("elements", lambda e: F.struct(
        e.tag.alias("tag"), e.role_button.alias("role"), F.coalesce(F.nullif(content(e), F.lit("")), clean(e.instead)).alias("text"), e.clickable.alias("clickable"), e.dialog.alias("dialog"),
        (e.card & F.exists("_media", lambda m: (m > e.at) & (m < e.end))).alias("card")))
    told = rows.withColumn("_media", media).withColumn("_texts", F.coalesce(texts, F.array().cast("array<struct<tag:string,role:boolean,text:string,clickable:boolean,dialog:boolean,card:boolean>>")))

    def listed(tags, pattern):
        fits = lambda e: (e.tag.isin(tags) | (e.role if "[role]" in tags else F.lit(False))) & (e.text.rlike(pattern) if pattern else F.lit(True))
        return F.transform(F.filter("_texts", fits), lambda e: e.text)

    count = lambda test: F.size(F.filter("_texts", test))
    calls = F.transform(F.filter("_texts", lambda e: e.clickable & (e.text != "")), lambda e: e.text)
    blocks = F.filter(listed(BLOCKS, None), lambda t: F.length(t) >= BLOCK_LENGTH)
    return told.select(
        *names, *[first_distinct(listed(tags, pattern), limit).alias(n) for n, (tags, pattern, limit) in LISTS.items()],
        F.least(F.size(F.array_distinct(F.transform(blocks, F.lower))), F.lit(MOST_BLOCKS)).alias("text_block_count"),
        count(lambda e: e.dialog).alias("dialog_count"), count(lambda e: e.clickable).alias("clickable_count"), count(lambda e: e.card & (F.length(e.text) >= 3)).alias("product_card_count"),
        F.slice(calls, 1, 30).alias("cta_texts"))


#: Counts of tags, by tag and test of the tag's inside.
def _typed(*kinds):
    return lambda tag: F.lower(attribute(tag, "type")).isin(list(kinds))


COUNTS = {
    "form_count": (["form"], None), "input_count": (["input"], None), "checkbox_count": (["input"], _typed("checkbox")), "radio_count": (["input"], _typed("radio")),
    "range_count": (["input"], _typed("range")), "number_input_count": (["input"], _typed("number")), "select_count": (["select"], None), "option_count": (["option"], None),
    "button_count": (["button", "input"], _typed("button", "submit")), "text_input_count": (["textarea", "input"], _typed("text")),
    "img_count": (["img"], None), "svg_count": (["svg"], None), "canvas_count": (["canvas"], None), "iframe_count": (["iframe"], None), "video_count": (["video"], None),
    "model_viewer_count": (["model-viewer"], None), "anchor_count": (["a"], lambda tag: F.trim(attribute(tag, "href")) != ""),
    "ar_rel_link_count": (["a"], lambda tag: F.contains(F.lower(attribute(tag, "rel")), F.lit("ar"))),
    "image_extension_src_count": (["img"], lambda tag: rules.contains_any(F.lower(attribute(tag, "src")), [".jpg", ".jpeg", ".png", ".webp"])),
    "usdz_link_count": (["a", "source", "model-viewer"], lambda tag: rules.contains_any(F.lower(F.coalesce(F.nullif(attribute(tag, "href"), F.lit("")), attribute(tag, "src"))), [".usdz", "scene-viewer", "quick-look"])),
}


def tag_facts(pages: DataFrame, html="html") -> DataFrame:
    """``pages`` with the counts of ``COUNTS``, image and script sources, and both descriptions. No shuffle."""
    tags = F.transform(F.filter(_pieces(html)[0], lambda t: t.rlike("(?i)^(form|input|select|option|button|textarea|img|svg|canvas|iframe|video|model-viewer|a|source|meta)\\b")), lambda t: F.struct(
        F.lower(F.regexp_extract(t, NAME, 2)).alias("tag"), t.alias("inside")))
    scripts = F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit("(?is)<script\\b([^>]*)>"), 1), lambda s: F.trim(F.concat_ws(" ", attribute(s, "src"), attribute(s, "type"))))
    rows = pages.withColumn("_tags", tags)

    def counted(names, test):
        fits = lambda t: t.tag.isin(names) if test is None else (t.tag.isin(names) & ((t.tag != "input") | test(t.inside)) if len(names) == 2 and "input" in names else t.tag.isin(names) & test(t.inside))
        return F.size(F.filter("_tags", fits))

    meta = lambda key, name: F.coalesce(F.get(F.transform(F.filter("_tags", lambda t: (t.tag == "meta") & (F.lower(attribute(t.inside, key)) == name)), lambda t: F.trim(attribute(t.inside, "content"))), F.lit(0)), F.lit(""))
    return rows.select(
        *pages.columns, *[counted(names, test).alias(n) for n, (names, test) in COUNTS.items()],
        first_distinct(F.transform(F.filter("_tags", lambda t: t.tag == "img"), lambda t: F.trim(attribute(t.inside, "src"))), 12).alias("img_src_hints"),
        first_distinct(F.filter(scripts, lambda s: rules.contains_any(F.lower(s), v.SCRIPT_KEYWORDS)), 20).alias("script_hints"),
        meta("name", "description").alias("meta_description"), meta("property", "og:description").alias("meta_og_description"))
