"""Pages and API answers as columns: titles, links, prices, nested JSON."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from criba.functions.keys import canonical_url
from criba.functions.text import as_column

# Fixed value: product schema of a shop's JSON answer.
PRODUCT_JSON = "code string, name string, url string, price struct<value: double>, basePrice struct<value: double>, images array<struct<format: string, url: string>>"


def from_answer(c: Column | str, schema: str | StructType) -> Column:
    """A JSON answer by a fixed schema; null where it is no such JSON."""
    return F.from_json(as_column(c), schema, {"mode": "PERMISSIVE"})


def image_of(product: Column, kind: str = "product") -> Column:
    """URL of the first image of a kind; null for none."""
    return F.try_element_at(F.filter(product["images"], lambda i: i["format"] == kind), F.lit(1))["url"]


def listed_items(pages: DataFrame, answer: str, path: str, item_schema: str, keep: list[str]) -> DataFrame:
    """One row for each item of an array inside JSON answers, with the columns to keep."""
    parts = path.split(".")
    schema = f"array<struct<{item_schema}>>"
    for p in reversed(parts):
        schema = f"struct<{p}: {schema}>"
    tree = from_answer(answer, schema)
    for p in parts:
        tree = tree[p]
    return pages.select(*keep, F.explode(tree).alias("_i")).select(*keep, "_i.*")


def with_fallback(primary: DataFrame, second: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Answers of a first request, completed from a second one where they lack a value."""
    other = second.select(key, *[F.col(c).alias(f"_2{c}") for c in columns])
    return primary.join(other, key, "left").select(key, *[F.coalesce(c, f"_2{c}").alias(c) for c in columns])


def links(page: Column | str, site: str | None = None) -> Column:
    """Distinct canonical URLs of a page's links, in order of the alphabet."""
    found = F.regexp_extract_all(as_column(page), F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?[^"'\s>]+"""), F.lit(0))
    found = F.transform(found, lambda tag: F.regexp_extract(tag, r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)""", 1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda u: canonical_url(u, site))))


def title(page: Column | str) -> Column:
    """Text of the title element; null for none."""
    return F.nullif(F.trim(F.regexp_extract(as_column(page), r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def script_value(page: Column | str, name: str) -> Column:
    """Value of a quoted name with a number inside inline scripts (``"productId":"123"``)."""
    return F.nullif(F.regexp_extract(as_column(page), f'"{name}"\\s*:\\s*"?(\\d+)"?', 1), F.lit(""))


class _Texts(HTMLParser):
    """Texts of the elements that have one of the wanted classes or tags."""

    def __init__(self, wanted: dict[str, tuple[str | None, str | None]]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.found, self.open = wanted, {n: None for n in wanted}, []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        classes = (dict(attrs).get("class") or "").split()
        hit = [n for n, (t, c) in self.wanted.items() if (t is None or t == tag) and (c is None or c in classes) and self.found[n] is None]
        for n in hit:
            self.found[n] = ""
        if tag not in ("br", "img", "input", "meta", "link", "hr", "source"):
            self.open.append((tag, hit))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data: str) -> None:
        for _, names in self.open:
            for n in names:
                self.found[n] += data


def select_texts(pages: DataFrame, page: str, wanted: dict[str, tuple[str | None, str | None]]) -> DataFrame:
    """``pages`` with the text of the first element of each wanted (tag, class); null for none.

    Either of the two may be None. Blanks are squeezed; broken markup is read as far as it goes.
    """
    names = list(wanted)
    schema = StructType(list(pages.schema.fields))
    for n in names:
        schema = schema.add(n, "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch[page]:
                parser = _Texts(wanted)
                parser.feed(text or "")
                rows.append([None if v is None else " ".join(v.split()) for v in parser.found.values()])
            yield batch.assign(**{n: [r[i] for r in rows] for i, n in enumerate(names)})

    return pages.mapInPandas(run, schema)


def attribute(page: Column | str, tag: str, css: str, name: str) -> Column:
    """Value of an attribute of the first element of a tag and class; null for none."""
    element = F.regexp_extract(as_column(page), rf"""(?is)<{tag}\b[^>]*\bclass\s*=\s*["'][^"']*(?<![\w-]){css}(?![\w-])[^>]*>""", 0)
    return F.nullif(F.regexp_extract(element, rf"""(?i)\b{name}\s*=\s*["']([^"']*)["']""", 1), F.lit(""))


def _element_text(page: Column, tag: str) -> Column:
    inner = F.regexp_extract(page, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(inner, r"<[^>]*>", " "), r"\s+", " ")), F.lit(""))


def struck_and_current(page: Column | str, struck: tuple[str, ...] = ("del", "s", "strike"), current: tuple[str, ...] = ("ins", "bdi", "b")) -> tuple[Column, Column]:
    """Texts of the regular and the current price of a page that strikes the former out.

    The regular price stands in the first element of ``struck``, the current one in the first of ``current`` outside it;
    a page that shows one price only has it twice, one without any has nulls.
    """
    p = as_column(page)
    old = F.coalesce(*[_element_text(p, t) for t in struck])
    rest = p
    for t in struck:
        rest = F.regexp_replace(rest, rf"(?is)<{t}\b[^>]*>.*?</{t}>", " ")
    now = F.coalesce(*[_element_text(rest, t) for t in current])
    return F.coalesce(old, now), F.coalesce(now, old)


def fetched(requests: DataFrame, url: str, get: Callable[[str], tuple[int, str]], tries: int = 3, wait: float = 1.0, again: tuple[int, ...] = (408, 429, 468, 500, 502, 503, 504)) -> DataFrame:
    """``requests`` with ``estado`` and ``respuesta`` of what ``get`` brings for each URL.

    ``get`` (status and text of a URL) is the caller's: the library opens no connections. A status in ``again``, or an
    exception, is tried up to ``tries`` times with doubled waits; after that ``estado`` is the last status, or -1, and ``respuesta`` null.
    """
    schema = StructType([*requests.schema.fields]).add("estado", "integer").add("respuesta", "string")

    def one(address: str | None) -> tuple[int | None, str | None]:
        if not address:
            return None, None
        status = -1
        for i in range(tries):
            try:
                status, text = get(address)
                if status not in again:
                    return status, text if 200 <= status < 300 else None
            except Exception:  # noqa: BLE001 - one page must not end the job
                status = -1
            if i + 1 < tries:
                time.sleep(wait * 2**i)
        return status, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [one(a) for a in batch[url]]
            yield batch.assign(estado=pd.array([a[0] for a in answers], dtype="Int32"), respuesta=[a[1] for a in answers])

    return requests.mapInPandas(run, schema)


def paged(requests: DataFrame, url: str, get: Callable[[str], tuple[int, str]], items: Callable[[str], list[str]], first: int = 1, most: int = 10_000, **more) -> DataFrame:
    """One row an item of paged answers: ``requests``, ``pagina`` and ``item``, pages asked for until one has none.

    ``url`` holds a template with ``{page}``; ``items`` takes the items, as texts, out of an answer. ``most`` guards against
    a shop that never ends and raises where it is reached. A page that fails ends its list.
    """
    schema = StructType([*requests.schema.fields]).add("pagina", "integer").add("item", "string")
    tries, wait = more.get("tries", 3), more.get("wait", 1.0)

    def answer(address: str) -> str | None:
        for i in range(tries):
            try:
                status, text = get(address)
                if 200 <= status < 300:
                    return text
            except Exception:  # noqa: BLE001 - one page must not end the job
                pass
            if i + 1 < tries:
                time.sleep(wait * 2**i)
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.iloc[[i]]
                for page in range(first, first + most + 1):
                    if page == first + most:
                        raise ValueError(f"{row[url].iloc[0]}: over {most} pages")
                    text = answer(row[url].iloc[0].replace("{page}", str(page)))
                    found = items(text) if text is not None else []
                    if not found:
                        break
                    yield row.loc[row.index.repeat(len(found))].assign(pagina=np.int32(page), item=found)

    return requests.mapInPandas(run, schema)
