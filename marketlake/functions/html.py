"""Article fields of HTML pages, by site rule."""

from __future__ import annotations

import sys
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ship the code below with the query: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Where each news site keeps its fields ("tag.class", ".class" or "tag").
SITE_RULES = {
    "cafef": {
        "title": "h1.title",
        "sapo": "h2.sapo",
        "content": ".detail-content",
        "publish_time": ".pdate",
    },
    "vneconomy": {
        "title": "h1.detail-title",
        "sapo": "h2.detail-sapo",
        "content": ".detail-content",
        "publish_time": ".detail-time",
    },
    "vnexpress": {
        "title": "h1.title-detail",
        "sapo": "p.description",
        "content": "article.fck_detail",
        "publish_time": ".date",
    },
}
FIELDS = ("title", "sapo", "content", "publish_time")
FIELD_TYPE = "struct<title:string,sapo:string,content:string,publish_time:string>"

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
UNSEEN = frozenset(("script", "style", "template"))


class _FieldReader(HTMLParser):
    """Text of the first element matching each selector; tolerates unclosed tags."""

    def __init__(self, rules: dict[str, str]) -> None:
        super().__init__(convert_charrefs=False)
        self.wanted = {name: sel.partition(".")[::2] for name, sel in rules.items()}
        self.open_tags: list[str] = []
        self.depth: dict[str, int] = {}
        self.found: dict[str, list[str]] = {}
        self.run: list[str] = []

    def end_run(self) -> None:
        text = "".join(self.run).strip()
        self.run.clear()
        if text and not UNSEEN.intersection(self.open_tags):
            for name in self.depth:
                self.found[name].append(text)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.end_run()
        classes = next((v or "" for k, v in attrs if k == "class"), "").split()
        for name, (want_tag, want_class) in self.wanted.items():
            fits = want_tag in ("", tag) and (not want_class or want_class in classes)
            if fits and name not in self.found:
                self.found[name] = []
                if tag not in VOID:
                    self.depth[name] = len(self.open_tags)
        if tag not in VOID:
            self.open_tags.append(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.end_run()
        if tag in self.open_tags:
            while self.open_tags.pop() != tag:
                pass
            level = len(self.open_tags)
            self.depth = {n: d for n, d in self.depth.items() if d < level}

    def handle_data(self, data: str) -> None:
        self.run.append(data)

    def handle_entityref(self, name: str) -> None:
        self.run.append(html5.get(f"{name};", f"&{name}"))

    def handle_charref(self, name: str) -> None:
        code = int(name[1:], 16) if name[:1] in "xX" else int(name)
        self.run.append(chr(code) if 0 < code < 0x110000 else "\N{REPLACEMENT CHARACTER}")

    def handle_comment(self, data: str) -> None:
        self.end_run()

    handle_decl = handle_pi = unknown_decl = handle_comment


def read_fields(html: str | None, rules: dict[str, str] | None) -> dict[str, str] | None:
    """Fields of one page; a field not found is ``''``, an unreadable page is None."""
    if html is None or rules is None:
        return None
    reader = _FieldReader(rules)
    try:
        reader.feed(html)
        reader.close()
        reader.end_run()
    except (ValueError, AssertionError):
        return None
    return {name: "".join(reader.found.get(name, ())) for name in FIELDS}


def article_fields(
    html: Column, site: Column, rules: dict[str, dict[str, str]] | None = None
) -> Column:
    """Struct of the article fields. Arrow batches go to Python with these two columns only.

    Marked as not deterministic, or a filter on a field would parse every page once more.
    """
    by_site = rules or SITE_RULES

    @F.pandas_udf(FIELD_TYPE)
    def extract(pages: pd.Series, sites: pd.Series) -> pd.DataFrame:
        rows = [read_fields(h, by_site.get(s)) for h, s in zip(pages, sites)]
        empty = dict.fromkeys(FIELDS)
        return pd.DataFrame([r or empty for r in rows], columns=list(FIELDS), dtype=object)

    return extract.asNondeterministic()(html, site)


def parse_articles(
    pages: DataFrame,
    site: str = "source",
    html: str = "html",
    rules: dict[str, dict[str, str]] | None = None,
) -> DataFrame:
    """Replace the page text by its article fields; pages that cannot be read are dropped.

    A site without rule gives empty fields.
    """
    known = dict(rules or SITE_RULES)
    fields = article_fields(
        F.col(html),
        F.when(F.col(site).isin(*known), F.col(site)).otherwise(F.lit("")),
        {**known, "": {}},
    )
    others = [c for c in pages.columns if c != html]
    return (
        pages.where(F.col(html).isNotNull())
        .select(*others, fields.alias("_fields"))
        .where(F.col("_fields.title").isNotNull())
        .select(*others, "_fields.*")
    )
