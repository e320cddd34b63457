"""Archived pages to rows, as distributed jobs.

Python runs only inside `mapInArrow`, for the one thing Spark has no expression for: splitting HTML into table cells.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from html import unescape
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..functions import urls
from ..functions.text import CP1252_FROM, CP1252_TO, Str, _col, squish
from ..session import small_batches


# --- raw pages -------------------------------------------------------------

def read_pages_with_metadata(spark: SparkSession, pages: str, metadata: str, suffix: str = ".meta.json",
                             keep_missing: bool = False) -> DataFrame:
    """Raw page files joined to their sidecar JSON by path stem; pages without one are skipped or kept empty."""
    raw = (spark.read.format("binaryFile").load(pages)
           .where(~F.col("path").endswith(suffix))
           .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("page"), "content", "modificationTime"))
    meta = (spark.read.text(metadata, wholetext=True)
            .select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("f"), F.col("value").alias("metadata"))
            .select(F.expr(f"left(f, length(f) - {len(suffix)})").alias("page"), "metadata"))
    return raw.join(meta, "page", "left" if keep_missing else "inner")


def pages_with_context(pages: DataFrame, metadata: DataFrame, key: str, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Pages with their metadata row; without `defaults` a page that has none is skipped."""
    out = pages.join(metadata, key, "inner" if defaults is None else "left")
    return out.withColumns({c: F.coalesce(F.col(c), d) for c, d in (defaults or {}).items()})


def decode_page(content: Str) -> Column:
    """UTF-8; else lossy UTF-8 when the page declares it; else windows-1252; else latin-1."""
    raw = _col(content)
    as_text = raw.cast("string")
    latin = F.decode(raw, "iso-8859-1")
    head = F.lower(latin)
    undefined = latin.rlike("[\\x81\\x8d\\x8f\\x90\\x9d]")
    return (F.when(F.is_valid_utf8(as_text), as_text)
            .when(head.contains("utf-8") | head.contains("utf8"), F.make_valid_utf8(as_text))
            .when(~undefined, F.translate(latin, CP1252_TO, CP1252_FROM)).otherwise(latin))


# fixed values: the byte runs that are characters in UTF-8, written as latin-1 characters
_TAIL = r"[\x80-\xBF]"
_WIDE = "|".join((rf"[\xC2-\xDF]{_TAIL}", rf"\xE0[\xA0-\xBF]{_TAIL}", rf"[\xE1-\xEC\xEE\xEF]{_TAIL}{{2}}", rf"\xED[\x80-\x9F]{_TAIL}",
                  rf"\xF0[\x90-\xBF]{_TAIL}{{2}}", rf"[\xF1-\xF3]{_TAIL}{{3}}", rf"\xF4[\x80-\x8F]{_TAIL}{{2}}"))
_BYTE_RUNS = rf"[\x00-\x7F]+|(?:{_WIDE}){{1,200}}|[\x80-\xFF]"  # a run of wide characters is bounded: the pattern recurses over it
_NO_WINDOWS = "\x81\x8d\x8f\x90\x9d"  # fixed value: bytes windows-1252 leaves undefined


def decode_mixed(content: Str) -> Column:
    """Bytes that mix encodings: what is UTF-8 as UTF-8, every other byte as windows-1252, an undefined one as U+FFFD.

    All expressions: bytes as latin-1 characters, cut into runs by a pattern, each run decoded or translated.
    """
    latin = F.decode(_col(content), "iso-8859-1")
    run = F.transform(F.regexp_extract_all(latin, F.lit(_BYTE_RUNS), F.lit(0)), lambda r: F.when(
        F.length(r) > 1, F.decode(F.encode(r, "iso-8859-1"), "utf-8")).otherwise(F.translate(r, CP1252_TO + _NO_WINDOWS, CP1252_FROM + "\uFFFD" * len(_NO_WINDOWS))))
    whole = _col(content).cast("string")
    return F.when(F.is_valid_utf8(whole), whole).otherwise(F.array_join(run, ""))


def decode_mixed_pages(df: DataFrame, key: str, content: str, name: str = "html") -> DataFrame:
    return df.select(key, decode_mixed(content).alias(name))


# --- tables ----------------------------------------------------------------

# fixed values: what HTML allows a cell to span
MOST_COLUMNS, MOST_ROWS = 1000, 65534
GRID_CELLS = 1 << 20  # cells of one table after repeating; beyond it the spans of that table are not repeated
FRAME_CELLS = 1 << 16  # cells that go back from Python at once
PART_CELLS = 1 << 12  # cells of a table's rows that stand together in one part
HEAD_ROWS = 4  # rows at the top of a table that may be its header, at most
_FIGURE = re.compile(r"[#$]?[-+]?\d[\d.,:%/()\-]*")
_SECTIONS = ("div", "section", "article", "form")

# fixed values: tags that can be read in one way only, and the elements whose content a parser may not read as tags
_SPACE = r"[ \t\n\r\f]"
_ATTRIBUTE = re.compile(rf"""{_SPACE}+([a-zA-Z][a-zA-Z0-9_:-]*)(=(?:"([^"<>]*)"|'([^'<>]*)'|([^\s"'<>=`/]+)))?""")
_PLAIN = re.compile(rf"""<(?:(/?)([a-zA-Z][a-zA-Z0-9]*)|([a-zA-Z][a-zA-Z0-9]*)((?:{_SPACE}+[a-zA-Z][a-zA-Z0-9_:-]*(?:=(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>=`/]+))?)+)){_SPACE}*>""")
_BARE = re.compile(rf"(<table(?:{_SPACE}[^<>]*)?>)((?:[^<]*+</?t[dr]>)++[^<]*+)</table>")  # a table of nothing but rows and cells
_RAW = frozenset("script style textarea title iframe noembed noframes noscript plaintext xmp".split())


class _TableReader(HTMLParser):
    """Cells of every table of one page; tags the page forgot to close are closed by the next one."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self.open, self.sections = [], [], []

    def handle_starttag(self, tag, attrs):
        if tag in _SECTIONS:
            self.sections.append((tag, dict(attrs).get("id") or ""))
        if tag == "table":
            named = dict(attrs)
            self.tables.append({"rows": [], "head": [], "spans": False, "bare": False, "kind": named.get("class") or "", "section": "/".join(i for _, i in self.sections if i)})
            self.open.append({"t": self.tables[-1], "row": None, "cell": None, "thead": False})
        elif self.open:
            o = self.open[-1]
            if tag == "thead":
                o["thead"] = True
            elif tag == "tr":
                self._end_row(o)
                o["row"], o["all_th"] = [], True
            elif tag in ("td", "th"):
                self._end_cell(o)
                if o["row"] is None:
                    o["row"], o["all_th"] = [], True
                spans = {k: int(v) for k, v in attrs if k in ("colspan", "rowspan") and v and v.isdecimal()}
                o["t"]["spans"] = o["t"]["spans"] or bool(spans)
                o["cell"] = {"text": [], "col": spans.get("colspan", 1), "down": spans.get("rowspan", 1), "link": None, "alt": None}
                o["all_th"] = o["all_th"] and tag == "th"
            elif tag == "br" and o["cell"]:
                o["cell"]["text"].append(" ")
            elif tag in ("a", "img") and o["cell"]:
                what, attr = ("link", "href") if tag == "a" else ("alt", "alt")
                o["cell"][what] = o["cell"][what] or dict(attrs).get(attr)

    def handle_endtag(self, tag):
        if tag in _SECTIONS and any(t == tag for t, _ in self.sections):
            while self.sections.pop()[0] != tag:
                pass
        if not self.open:
            return
        o = self.open[-1]
        if tag in ("td", "th"):
            self._end_cell(o)
        elif tag == "tr":
            self._end_row(o)
        elif tag == "thead":
            self._end_row(o)
            o["thead"] = False
        elif tag == "table":
            self._end_row(o)
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"]:
            self.open[-1]["cell"]["text"].append(data)

    def _end_cell(self, o):
        c = o["cell"]
        if c:
            o["row"].append(((" ".join("".join(c["text"]).split()), c["link"], c["alt"]), max(c["col"], 1), max(c["down"], 1)))
            o["cell"] = None

    def _end_row(self, o):
        self._end_cell(o)
        if o["row"]:
            is_head = o["thead"] or (o["all_th"] and not o["t"]["rows"])
            o["t"]["head" if is_head else "rows"].append(o["row"])
        o["row"] = None


def _plain_tags(html: str) -> list[str | None] | None:
    """Texts and tags of a page in turn (text, slash, tag, tag with attributes, its attributes, text, ..); None if any of its
    markup takes more than `_PLAIN` to read."""
    parts = _PLAIN.split(html)
    if 5 * html.count("<") + 1 != len(parts):
        return None
    return None if any(t and t.lower() in _RAW for k in (2, 3) for t in set(parts[k::5])) else parts


def _read_plain(reader: _TableReader, parts: list[str | None]) -> None:
    """What `reader` makes of the page when it is fed, without HTMLParser; cells without attributes are opened right here."""
    opened = reader.open
    names = {t: t.lower() for k in (2, 3) for t in set(parts[k::5]) if t}
    for text, slash, tag, named, attrs in zip(parts[::5], parts[1::5], parts[2::5], parts[3::5], parts[4::5], strict=False):
        if text and opened and opened[-1]["cell"]:
            opened[-1]["cell"]["text"].append(unescape(text) if "&" in text else text)
        if named:
            found = _ATTRIBUTE.findall(attrs)
            reader.handle_starttag(names[named], [(a.lower(), unescape(x + y + z) if rest else None) for a, rest, x, y, z in found])
            continue
        tag = names[tag]
        if slash:
            reader.handle_endtag(tag)
        elif tag == "td" and opened:
            o = opened[-1]
            if o["cell"]:
                reader._end_cell(o)
            if o["row"] is None:
                o["row"] = []
            o["all_th"] = False
            o["cell"] = {"text": [], "col": 1, "down": 1, "link": None, "alt": None}
        else:
            reader.handle_starttag(tag, [])
    if parts[-1]:
        reader.handle_data(unescape(parts[-1]))


def _bare_rows(body: str) -> Iterator[list[str]]:
    """Texts of a table without other tags: a row ends where one begins or ends, and so does a cell."""
    for line in body.replace("</tr>", "<tr>").split("<tr>"):
        cells = line.split("<td>")
        if len(cells) > 1:
            if "</td>" in line:
                cells = [x.partition("</td>")[0] for x in cells]
            if "&" in line:
                cells = [unescape(x) for x in cells]
            yield [" ".join(x.split()) for x in cells[1:]]


def _read(html: str) -> _TableReader:
    """The page's tables; HTMLParser reads what is not plain."""
    pieces = _BARE.split(html)
    plain = [_plain_tags(before + tag) for before, tag in zip(pieces[::3], [*pieces[1::3], ""], strict=True)]
    reader = _TableReader()
    if None in plain:
        reader.feed(html)
        reader.close()
        return reader
    for parts, body in zip(plain, [*pieces[2::3], None], strict=True):
        _read_plain(reader, parts)
        if body is not None:
            reader.open.pop()["t"].update(bare=True, rows=list(_bare_rows(body)))
    return reader


def _spread(rows: list, repeat: bool = True) -> list[list[tuple]]:
    """Repeat cells over their column and row spans."""
    out, hanging = [], {}
    for row in rows:
        line, cells = [], iter(row)
        while True:
            if len(line) in hanging:
                cell, left = hanging.pop(len(line))
                if left > 1:
                    hanging[len(line)] = (cell, left - 1)
                line.append(cell)
                continue
            cell = next(cells, None)
            if cell is None:
                break
            content, wide, down = cell if repeat else (cell[0], 1, 1)
            for _ in range(min(wide, MOST_COLUMNS)):
                if down > 1:
                    hanging[len(line)] = (content, min(down, MOST_ROWS) - 1)
                line.append(content)
        out.append(line)
    return out


def _too_wide(rows: list) -> bool:
    """Whether repeating would make more cells than a table may have: a row holds at most what it and the rows above span."""
    total = hanging = 0
    for row in rows:
        wide = sum(min(c[1], MOST_COLUMNS) for c in row)
        total += wide + hanging
        hanging += sum(min(c[1], MOST_COLUMNS) for c in row if c[2] > 1)
        if total > GRID_CELLS:
            return True
    return False


def _mostly_figures(row: list[str]) -> bool:
    known = [c for c in row if c]
    return 2 * sum(bool(_FIGURE.fullmatch(t)) for t in known) >= max(len(known), 1)


def _head_of(rows: list[list[str]]) -> int:
    """How many leading rows name the columns of a table that marks none: those above its first row of figures."""
    first = next((i for i, r in enumerate(rows) if any(r) and _mostly_figures(r)), None)
    return 0 if len(rows) < 2 or first == 0 else 1 if first is None or first > HEAD_ROWS else first


def _page_tables(html: str) -> Iterator[dict]:
    """Each table: no, kind, section, head (marked header rows) and rows as texts, links and alts of the rows' cells (None if
    no cell can have any), clipped (a span was not followed)."""
    reader = _read(html or "")
    for o in reader.open:
        reader._end_row(o)
    for no, t in enumerate(reader.tables):
        named = {"no": no, "kind": t["kind"], "section": t["section"]}
        if t["bare"]:
            yield {**named, "head": [], "rows": t["rows"], "links": None, "alts": None, "clipped": sum(map(len, t["rows"])) > GRID_CELLS}
            continue
        wide = _too_wide(t["head"] + t["rows"])
        clipped = wide or any(c[1] > MOST_COLUMNS or c[2] > MOST_ROWS for r in t["head"] + t["rows"] for c in r)
        head, body = ([[c[0] for c in r] for r in t[k]] if not t["spans"] else _spread(t[k], not wide) for k in ("head", "rows"))
        rows, links, alts = ([[c[i] for c in r] for r in body] for i in range(3))
        yield {**named, "head": [[c[0] for c in r] for r in head], "rows": rows, "links": links, "alts": alts, "clipped": clipped}


class _Frame:
    """Some rows, read by column."""

    def __init__(self, rows: list[tuple], columns: Sequence[str]):
        self.rows, self.at = rows, {c: i for i, c in enumerate(columns)}

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, column: str) -> list:
        i = self.at[column]
        return [r[i] for r in self.rows]


def _frames(rows: Iterable[tuple], columns: Sequence[str]) -> Iterator[_Frame]:
    """Frames of rows; a frame ends when the lists in it hold FRAME_CELLS cells, header cells included, as each row brings its own."""
    part, n = [], 0
    for r in rows:
        part.append(r)
        n += 1
        for x in r:
            if type(x) is list:
                n += sum(map(len, x)) if x and type(x[0]) is list else len(x)
        if n >= FRAME_CELLS:
            yield _Frame(part, columns)
            part, n = [], 0
    if part:
        yield _Frame(part, columns)


def _rows_of_pages(pages: DataFrame, key: str, html: str, schema: str, rows) -> DataFrame:
    """`rows` of every table of every page, in frames of at most about FRAME_CELLS cells. Pages without a table never reach Python."""
    small_batches(pages.sparkSession)
    schema = f"{key} {dict(pages.dtypes)[key]}, {schema}"
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = ((k, *r) for k, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for t in _page_tables(h) for r in rows(t))
            for f in _frames(found, target.names):
                yield pa.RecordBatch.from_arrays([pa.array(f[c.name], c.type) for c in target], schema=target)

    return pages.where(F.col(html).rlike("(?i)<table")).select(key, html).mapInArrow(run, schema)


def extract_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(page, table_no, row_no, header, cells) for every row of every table."""

    def rows(t: dict):
        head = t["head"][-1] if t["head"] else []
        for i, cells in enumerate(t["rows"]):
            yield t["no"], i, head, cells

    return _rows_of_pages(pages, key, html, "table_no int, row_no int, header array<string>, cells array<string>", rows)


def extract_grids(pages: DataFrame, key: str, html: str, parts: bool = False) -> DataFrame:
    """Rows of every table under its whole header: `head` holds all header rows, top first, marked ones or (where a table
    marks none) the leading rows above its first row of figures; `n_rows` counts the rows below. Cells come with the first
    link and picture text inside them, tables with their class and the ids of the sections around them. `clipped` says
    that a span beyond HTML's limits, or a table beyond GRID_CELLS, was not repeated in full.

    With `parts` up to about PART_CELLS cells stand together, so that what is worked out from a header is worked out once
    for many rows: `cells`, `links` and `alts` hold a list for each row, and `row_no` is the place of the first one."""

    def table(t: dict):
        head, cells = t["head"], [t["rows"], *(t[k] or [[None] * len(r) for r in t["rows"]] for k in ("links", "alts"))]
        if not head:
            n = _head_of(t["rows"])
            head, cells = t["rows"][:n], [x[n:] for x in cells]
        return head, cells

    def rows(t: dict):
        head, cells = table(t)
        for i, row in enumerate(zip(*cells, strict=True)):
            yield t["no"], i, len(cells[0]), t["kind"], t["section"], head, *row, t["clipped"]

    def together(t: dict):
        head, cells = table(t)
        first = n = 0
        for end, texts in enumerate(cells[0], 1):
            n += len(texts)
            if n >= PART_CELLS or end == len(cells[0]):
                yield t["no"], first, len(cells[0]), t["kind"], t["section"], head, *(x[first:end] for x in cells), t["clipped"]
                first, n = end, 0

    kind = "array<array<string>>" if parts else "array<string>"
    return _rows_of_pages(pages, key, html, "table_no int, row_no int, n_rows int, kind string, section string, head array<array<string>>, "
                          f"cells {kind}, links {kind}, alts {kind}, clipped boolean", together if parts else rows)


def caption(head: Str = "head") -> Column:
    """Texts of header rows that run across the whole table, joined."""
    across = F.filter(_col(head), lambda r: (F.size(r) > 1) & (F.size(F.array_distinct(r)) == 1))
    return F.array_join(F.transform(across, lambda r: squish(F.get(r, 0))), " ")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once a row, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def column_paths(head: Str = "head") -> Column:
    """The header tree, one array of labels a column from the top down: a label over several columns belongs to each,
    one over several rows counts once, rows that run across the whole table name no column."""
    naming = F.filter(_col(head), lambda r: ~((F.size(r) > 1) & (F.size(F.array_distinct(r)) == 1)))

    def path(rows, i):
        labels = F.filter(F.transform(rows, lambda r: squish(F.coalesce(F.get(r, i), F.lit("")))), lambda x: x != "")
        return _once(labels, lambda known: F.filter(known, lambda x, at: (at == 0) | (x != F.get(known, at - 1))))

    def paths(rows):
        width = F.array_max(F.transform(rows, lambda r: F.size(r)))
        return F.when(width > 0, F.transform(F.sequence(F.lit(0), width - 1), lambda i: path(rows, i))).otherwise(F.array().cast("array<array<string>>"))

    return _once(naming, paths)


def named_cells(grid: DataFrame, labels: Mapping[str, tuple[str, int]], paths: str = "paths", cells: str = "cells") -> DataFrame:
    """Cells by the last label of their column's path, or its labels joined by " / ", and which of several equal ones (from 1).
    A column the table lacks is NULL, so columns may move, and new ones may come between."""
    zipped = F.transform(paths, lambda p, i: F.struct(F.try_element_at(p, F.lit(-1)).alias("leaf"), F.array_join(p, " / ").alias("path"), F.get(cells, i).alias("cell")))
    out = grid.withColumn("__z", F.when(F.size(paths) > 0, zipped))

    def cell(label, nth):
        return F.get(F.filter("__z", lambda z: (z["leaf"] == label) | (z["path"] == label)), nth - 1)["cell"]

    return out.select("*", *[cell(label, nth).alias(name) for name, (label, nth) in labels.items()]).drop("__z")


def first_table(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each page's first table among these."""
    return rows.withColumn("__first", F.min("table_no").over(Window.partitionBy(key))).where("table_no = __first").drop("__first")


def first_row_as_header(cells: DataFrame, key: str) -> DataFrame:
    """For tables without header cells: their first row names the columns."""
    head = cells.where((F.size("header") == 0) & (F.col("row_no") == 0)).select(key, "table_no", F.col("cells").alias("__h"))
    return (cells.join(head, [key, "table_no"], "left")
            .where(F.col("__h").isNull() | (F.col("row_no") > 0))
            .withColumn("header", F.coalesce("__h", "header")).drop("__h"))


# fixed values: statistic columns between games and average, and the board they identify
BOARDS = """('TOT', 'anotaciones', 'per_game'), ('DEF|OFF|TOT', 'rebotes', 'per_game'), ('TLA', 'tiros_libres_anotados', 'per_game'),
 ('TLI|TLA', 'tiros_libres_pct', 'percentage'), ('CC3', 'canastos_3', 'per_game'), ('3PI|3PA', 'canastos_3_pct', 'percentage'),
 ('TB', 'bloqueos', 'per_game'), ('CB', 'cortes_balon', 'per_game'), ('TO', 'turnovers', 'per_game'),
 ('RO', 'rebotes_ofensivos', 'per_game'), ('TA', 'asistencias', 'per_game')"""


def leader_boards(cells: DataFrame, lead: Sequence[str] = ("#", "Jugador", "JJ"), last: str = "Prom") -> DataFrame:
    """Leader-board rows by header signature. An unknown signature is kept under a derived name, never dropped."""
    h = F.transform("header", lambda c: squish(c))
    n = F.size("header")
    is_board = (n > len(lead)) & (F.element_at(h, -1) == last)
    for i, name in enumerate(lead):
        is_board = is_board & (F.get(h, F.lit(i)) == name)
    aux = F.slice(h, F.lit(len(lead) + 1), F.greatest(n - len(lead) - 1, F.lit(0)))
    boards = cells.sparkSession.sql(f"SELECT * FROM VALUES {BOARDS} AS b(signature, category, prom_kind)")
    slug = F.concat(F.lit("cat_"), F.array_join(F.transform(aux, lambda a: F.regexp_replace(F.lower(a), "[^a-z0-9]", "")), "_"))
    return (cells.where(is_board).withColumn("signature", F.array_join(F.transform(aux, lambda a: F.upper(a)), "|"))
            .withColumn("__slug", slug)
            .join(F.broadcast(boards), "signature", "left")
            .withColumn("known", F.col("category").isNotNull())
            .withColumns({"category": F.coalesce("category", "__slug"), "prom_kind": F.coalesce("prom_kind", F.lit("unknown"))})
            .drop("__slug"))


def labelled_cells(cells: DataFrame, labels: Mapping[str, str], header: str = "header") -> DataFrame:
    """Cells by column label; a label the table lacks gives NULL, so columns may move."""
    names = F.transform(header, lambda c: squish(c))
    width = F.least(F.size(names), F.size("cells"))
    by_label = F.map_from_entries(F.array_distinct(F.transform(
        F.sequence(F.lit(0), width - 1),
        lambda i: F.struct(F.concat_ws("#", F.get(names, i), F.array_position(names, F.get(names, i)).cast("string")).alias("k"),
                           F.get("cells", F.array_position(names, F.get(names, i)).cast("int") - 1).alias("v")))))
    out = cells.withColumn("__m", F.when(width > 0, by_label))

    def cell(label):
        at = F.array_position(names, F.lit(label))
        return F.when(at > 0, F.try_element_at("__m", F.concat_ws("#", F.lit(label), at.cast("string"))))

    return out.select("*", *[cell(label).alias(name) for name, label in labels.items()]).drop("__m")


def divider_groups(rows: DataFrame, keys: Sequence[str], order: str, is_divider: Column, label: Column) -> DataFrame:
    """Rows under a divider row carry its label; the dividers go. One page's table is one small group."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("group_label", F.last(F.when(is_divider, label), ignorenulls=True).over(w))
            .where(~F.coalesce(is_divider, F.lit(False))))


# --- page text ---------------------------------------------------------------

def strip_tags(html: Str) -> Column:
    s = F.regexp_replace(_col(html), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    s = F.regexp_replace(s, r"(?s)<[^>]*>", " ")
    for code, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(code), F.lit(char))
    return squish(s)


def page_title(html: Str) -> Column:
    t = squish(F.regexp_extract(_col(html), r"(?is)<title[^>]*>(.*?)</title>", 1))
    return F.when(t != "", t)


def page_parameter(url: Str, html: Str, parameter: str, selects: Sequence[str]) -> Column:
    """A context value from the URL first, else from the option selected in one of the named forms."""
    names = "|".join(selects)
    block = F.regexp_extract(_col(html), rf"""(?is)<select[^>]*name\s*=\s*["']?(?:{names})["']?[\s>].*?</select>""", 0)
    tag = F.regexp_extract(block, r"(?is)<option[^>]*\bselected\b[^>]*>", 0)
    value = F.regexp_extract(tag, r"""(?is)value\s*=\s*["']?([^"'\s>]*)""", 1)
    return F.coalesce(urls.parameter(url, parameter), F.when(value != "", value))


def labelled_blocks(text: Str, labels: Sequence[str]) -> Column:
    """struct of the text after each label up to the next label of the list; absent or empty is NULL."""
    s = squish(text)

    def after(i):
        stop = "|".join([rf"\Q{x}\E" for x in labels[i + 1:]] + [r"\z"])
        v = F.trim(F.regexp_extract(s, rf"(?s)\Q{labels[i]}\E\s*:?\s*(.*?)\s*(?:{stop})", 1))
        return F.when(v != "", v)

    return F.struct(*[after(i).alias(re.sub(r"\W+", "_", x.lower()).strip("_")) for i, x in enumerate(labels)])


# fixed values: "rank. name (club) games figures average" in fixed-width leader blocks
LEADER_LINE = r"^\s*(\d+)\.\s+(.+?)\s+\(([A-Za-z .]+)\)\s+(\d+)\s+(.+?)\s+([\d.]+)\s*$"


def leader_lines(df: DataFrame, line: str) -> DataFrame:
    """Fixed-width leader lines to columns; a line of another shape keeps NULLs and says so."""
    ok = F.col(line).rlike(LEADER_LINE)

    def part(i):
        return F.when(ok, squish(F.regexp_extract(line, LEADER_LINE, i)))

    figures = F.transform(F.split(part(5), r"\s+"), lambda x: x.try_cast("int"))
    return df.select(
        "*", part(1).try_cast("int").alias("rank"), part(2).alias("player_raw"), part(3).alias("club_raw"),
        part(4).try_cast("int").alias("games"), figures.alias("figures"), part(6).try_cast("double").alias("prom"),
        F.when(ok, "").otherwise("unparsed").alias("parse_flag"))


class CareerLines(NamedTuple):
    rows: DataFrame
    rejected: DataFrame  # lines whose number is no season: there was no league yet


def career_lines(df: DataFrame, text: str, keys: Sequence[str], first: int = 1929) -> CareerLines:
    """ "YEAR TEAM figures..." runs of a page text. A full row ends in an average after games and points;
    a shorter one keeps its season and team with both figures unknown. A number before `first` begins no season's row: such
    lines are the second result."""
    row = r"(\d{4}\s+[A-ZÑÁÉÍÓÚ.\- ]+?\s+(?=\d).+?)(?=\s+\d{4}\s+[A-ZÑ]|\z)"
    out = (df.select(*keys, F.posexplode(F.regexp_extract_all(text, F.lit(row), F.lit(1))).alias("line_no", "line"))
           .withColumn("season", F.regexp_extract("line", r"^(\d{4})", 1).try_cast("int"))
           .withColumn("team_raw", squish(F.regexp_extract("line", r"^\d{4}\s+([A-ZÑÁÉÍÓÚ.\- ]+?)\s+(?=\d)", 1)))
           .withColumn("t", F.regexp_extract_all(F.regexp_replace("line", r"^\d{4}\s+[A-ZÑÁÉÍÓÚ.\- ]+?\s+(?=\d)", ""),
                                                 F.lit(r"(\d+\.\d+|\d+%|\d+)"), F.lit(1))))
    full = (F.size("t") >= 3) & F.try_element_at("t", F.lit(-1)).rlike(r"^\d+\.\d+$")

    def figure(i):
        v = F.try_element_at("t", F.lit(i))
        return F.when(full & v.rlike(r"^\d+$"), v.try_cast("int"))

    named = out.withColumns({"games": figure(-3), "points": figure(-2)}).drop("t")
    return CareerLines(named.where(F.col("season") >= first).drop("line"), named.where(F.col("season") < first).select(*keys, "line_no", "line"))


# --- lists, links, routing ---------------------------------------------------

def list_items(pages: DataFrame, key: str, html: str) -> DataFrame:
    items = F.regexp_extract_all(html, F.lit(r"(?is)<li[^>]*>(.*?)</li>"), F.lit(1))
    return (pages.select(key, F.posexplode(items).alias("position", "__i"))
            .select(key, "position", strip_tags("__i").alias("item")))


def page_links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Targets of links: quoted twice, once or not at all."""
    links = F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""), F.lit(1))
    return pages.select(key, F.posexplode(links).alias("position", "link")).withColumn("link", F.regexp_replace("link", r"""^["']|["']$""", ""))


def link_ids(links: DataFrame, pattern: str, name: str = "entity_id") -> DataFrame:
    """Entity ids inside link targets; links without one go."""
    v = F.regexp_extract("link", pattern, 1)
    return links.withColumn(name, F.when(v != "", v)).where(F.col(name).isNotNull())


def route_template(html: Str, routes: Sequence[tuple[str, Column]], default: str) -> Column:
    """First page shape whose test holds names the extractor."""
    out = None
    for name, test in routes:
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(default)


# fixed values: texts of database and challenge pages
ERROR_MARKS = ("ADODB.", "BOF or EOF", "Microsoft OLE DB")
CHALLENGE_MARKS = ("goCaptcha", "captchacode")


def reject_reason(html: Str, wrong_subject: str | None = None, least: int = 2, error_title: str = r"(?i)error|not found|forbidden") -> Column:
    """Why a page is unusable, else NULL. Wrong-subject pages need `least` marker links, one is noise."""
    s = _col(html)

    def any_of(marks):
        out = F.lit(False)
        for m in marks:
            out = out | s.contains(m)
        return out

    r = (F.when(any_of(ERROR_MARKS), "database_error").when(any_of(CHALLENGE_MARKS), "challenge")
         .when(F.coalesce(page_title(s).rlike(error_title), F.lit(False)), "error_title"))
    return r if wrong_subject is None else r.when(F.regexp_count(s, F.lit(wrong_subject)) >= least, "wrong_subject")


def split_rejected(pages: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    tagged = pages.withColumn("reject_reason", reason)
    return tagged.where(F.col("reject_reason").isNull()).drop("reject_reason"), tagged.where(F.col("reject_reason").isNotNull())


def coalesced_score(totals: DataFrame, parts: DataFrame, key: str, total: str, part: str, name: str = "score") -> DataFrame:
    """The stated total, else the sum of the parts when all are known."""
    summed = parts.groupBy(key).agg(F.when(F.count(part) == F.count("*"), F.sum(part)).alias("__s"))
    return (totals.join(summed, key, "left")
            .withColumn("score_source", F.when(F.col(total).isNotNull(), "stated").when(F.col("__s").isNotNull(), "summed").otherwise("unknown"))
            .withColumn(name, F.coalesce(total, "__s")).drop("__s"))
