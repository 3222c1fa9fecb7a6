"""Docket pages to movement rows.

Only reading the HTML runs in Python (Arrow batches of pages, one pass over
each page's tags, in time proportional to the page however broken it is); every
step after it is a native expression:

* P1  fault-tolerant map: every page yields its rows, or ONE row with
      ``return = 'error'`` when it cannot be read -- a failure never fails
      the job;
* P5  the first table holding the movements element, first row as header
      (snake-cased), keep the ``data`` and ``movimento`` columns; end tags may
      be left out, cells may span columns and rows; a page without that table
      is an error;
* P6  drop rows whose date text is empty;
* P7  split the movement text at newline+tab into title and body (rest
      stays in the body, missing body is NULL);
* P8  squish every column (Unicode whitespace, incl. NBSP);
* P9  day, month (number or name) and year; impossible dates give NULL.

A page may be saved again, the same day or later.  ``merge_movements`` takes
one page for each record: of its own day if the records have one, else the
newest as of a day.
"""

from __future__ import annotations

import html as _html
import re
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.markup import Markup
from ..functions.text import col, split_get, squish, unaccent
from .cases import case_tasks

# The page parser runs in Python workers, which may not have this package
# installed: ship this module's code with the task instead of by reference.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

# --- fixed values -----------------------------------------------------------
MOVEMENTS_ELEMENT_ID = "tabelaTodasMovimentacoes"
DATE_COLUMN = "data"
TEXT_COLUMN = "movimento"
TITLE_SEP = "\n\t"
DATE_FORMAT = "d/M/yyyy"
TWO_DIGIT_PIVOT = 68
MONTH_NAMES = [
    ("jan", "janeiro", "january"), ("fev", "fevereiro", "feb", "february"), ("mar", "marco", "march"),
    ("abr", "abril", "apr", "april"), ("mai", "maio", "may"), ("jun", "junho", "june"), ("jul", "julho", "july"),
    ("ago", "agosto", "aug", "august"), ("set", "setembro", "sep", "september"), ("out", "outubro", "oct", "october"),
    ("nov", "novembro", "november"), ("dez", "dezembro", "dec", "december"),
]
# ----------------------------------------------------------------------------

_USUAL = r"\A[0-9]{2}[-/.][0-9]{2}[-/.][1-9][0-9]{3}\z"
_GAP = "[^0-9a-z]+"
_NUMBERS = f"^([0-9]{{1,2}}){_GAP}([0-9]{{1,2}}){_GAP}([0-9]{{4}}|[0-9]{{2}})$"
_NAMED = f"^([0-9]{{1,2}})[^0-9a-z]*(?:de{_GAP})?([a-z]{{3,}})[^0-9a-z]*(?:de{_GAP})?([0-9]{{4}}|[0-9]{{2}})$"
_JOINED = "^([0-9]{2})([0-9]{2})([0-9]{4}|[0-9]{2})$"

PARSED_SCHEMA = ("file string, sg_date date, read timestamp, return string, error string, pos int, "
                 "movement_txt string, x3 string")


_RAW = ("script", "style")
_MARKUP = Markup(_RAW)
# the same tokens for pages cut by it: the first token that the markup's
# scanner would have to find takes the rest of the page
_PIECES = re.compile(
    r"(<!--.*?-->|<(?!!--)[!?][^>]*+>"
    + "".join(rf"|<{n}\b[^>]*+>.*?</{n}\s*+>" for n in _RAW) + rf"|<(?:{'|'.join(_RAW)})\b.*"
    r"|</?[a-zA-Z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|<.*)", re.S | re.I)
_CUT_AT_ONCE = 1 << 20    # characters of a page
_TAGS_KEPT, _TAG_KEPT = 10_000, 300
_ID = re.compile(r"""(?:^|\s)id\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPAN = re.compile(r"""(?:^|\s)(col|row)span\s*=\s*["']?\s*([0-9]{1,9})""", re.I)
_CHARSET = re.compile(rb"""<meta[^>]{0,1000}?charset\s*=\s*["']?\s*([a-zA-Z0-9_:.-]+)""", re.I)
_HEAD_END = re.compile(rb"</head\b|<body\b", re.I)
_MAX_COLSPAN = 1000  # HTML's own limit
_VOID = frozenset(["br", "img", "hr", "meta", "link", "input", "col", "area", "base",
                   "wbr", "source", "param", "embed", "track"])


def _scan(page: str, sink: "_Tables") -> None:
    """Comments, declarations and raw elements are skipped whole; every other
    token goes to ``sink``."""
    at = 0
    for start, end, tag, closing, attrs in _MARKUP.tokens(page):
        if start > at:
            sink.handle_data(page[at:start])
        at = end
        if closing is None:
            continue
        if closing:
            sink.handle_endtag(tag)
            continue
        sink.handle_starttag(tag, _ident(attrs), attrs)
        if _alone(tag, attrs):
            sink.handle_endtag(tag)
    if at < len(page):
        sink.handle_data(page[at:])


def _ident(attrs: str) -> str | None:
    a = _ID.search(attrs) if attrs else None
    return _html.unescape(a.group(1) or a.group(2) or a.group(3) or "") if a else None


def _alone(tag: str, attrs: str) -> bool:
    """Whether a start tag ends its element."""
    return tag in _VOID or bool(attrs) and attrs.rstrip().endswith("/")


def _token(piece: str) -> tuple | None:
    """``(tag, closing, ident, attributes, alone, kind of cell)`` of a piece;
    closing is None for what is skipped.  None for the rest of a page."""
    for start, end, tag, closing, attrs in _MARKUP.tokens(piece):
        if start or end < len(piece) or closing is False and _MARKUP.begin.match(piece):
            return None
        kind = _cell_kind(tag, attrs) if tag in _CELLS else None
        if closing is not False:
            return tag, closing, None, attrs, False, kind
        return tag, closing, _ident(attrs), attrs, _alone(tag, attrs), kind
    return None


def _tables(page: str, tags: dict) -> "_Tables":
    """The page's tables.  Well-formed pages are cut at once, and a tag that
    was met before is looked up in ``tags``."""
    found = _Tables()
    if len(page) > _CUT_AT_ONCE or not found.handle_pieces(_PIECES.split(page), tags):
        found = _Tables()
        _scan(page, found)
    found.finish()
    return found


def decode_page(raw: bytes) -> str:
    """Text of a saved page: byte order mark, else the declared charset, else
    UTF-8, else Windows-1252 (which is also what Latin-1 means in HTML)."""
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if raw.startswith(mark):
            return raw.decode(name, "replace")
    end = _HEAD_END.search(raw)
    found = _CHARSET.search(raw, 0, end.start() if end else len(raw))
    if found:
        name = found[1].decode("ascii").lower()
        name = "cp1252" if name in ("iso-8859-1", "latin1", "latin-1", "us-ascii", "windows-1252") else name
        try:
            return raw.decode(name, "replace")
        except LookupError:
            pass
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("cp1252", "replace")


def _flat(parts: list) -> str:
    """Text of nested lists of texts."""
    try:
        return "".join(parts).strip()
    except TypeError:
        pass
    out, todo = [], [iter(parts)]
    while todo:
        for x in todo[-1]:
            if isinstance(x, str):
                out.append(x)
            else:
                todo.append(iter(x))
                break
        else:
            todo.pop()
    return "".join(out).strip()


_TD, _TH = (False, 1, 1), (True, 1, 1)


class _Table:
    """Rows of one table; a cell that spans columns or rows is repeated.  A
    cell is a list of texts and of the lists of tables inside it: each text is
    kept once, however deep it stands, and joined only if it is asked for."""

    __slots__ = ("rows", "heads", "row", "kinds", "cell", "kind", "text", "below")

    def __init__(self):
        self.rows: list[list[list]] = []
        self.heads: list[bool] = []        # per row: made of <th> only
        self.row: list[list] | None = None
        self.kinds: list[tuple] = []       # of the row's cells: <th>, columns, rows
        self.cell: list | None = None
        self.kind: tuple = ()
        self.text: list = []               # all text of the table, if it stands in another one
        self.below: dict[int, tuple] = {}  # column -> (rows to come, cell)

    def add(self, text) -> None:
        self.text.append(text)
        if self.cell is not None:
            self.cell.append(text)

    def begin_row(self):
        self.row, self.kinds = [], []

    def end_cell(self):
        if self.cell is not None:
            self.row.append(self.cell)
            self.kinds.append(self.kind)
            self.cell = None

    def end_row(self):
        self.end_cell()
        if self.row:
            kinds = self.kinds
            heads = kinds.count(_TH)
            if not self.below and heads + kinds.count(_TD) == len(kinds):
                self.rows.append(self.row)
            else:
                heads = sum(k[0] for k in kinds)
                self.rows.append(self.spanned())
            self.heads.append(heads == len(kinds))
        self.row = None

    def spanned(self) -> list[list]:
        """The row's cells and those that reach into it from above."""
        out, below = [], {}

        def from_above():
            while len(out) in self.below:
                left, cell = self.below[len(out)]
                if left > 1:
                    below[len(out)] = (left - 1, cell)
                out.append(cell)

        for cell, (_, wide, high) in zip(self.row, self.kinds):
            from_above()
            if high == 1:
                out.extend([cell] * wide)
                continue
            for _ in range(wide):
                below[len(out)] = (high - 1 if high else 1 << 30, cell)
                out.append(cell)
        from_above()
        self.below = below
        return out


_CELLS, _ROWS, _GROUPS = ("td", "th"), ("tr",), ("thead", "tbody", "tfoot")
_ENDS = {"td": [_CELLS], "th": [_CELLS], "tr": [_CELLS, _ROWS], **dict.fromkeys(_GROUPS, [_CELLS, _ROWS, _GROUPS])}
_PARTS = frozenset([*_ENDS, "table"])


def _cell_kind(tag: str, attrs: str) -> tuple:
    """Whether a cell is a head, its columns and rows."""
    if not attrs or "pan" not in attrs.lower():
        return _TH if tag == "th" else _TD
    span = {k.lower(): int(n) for k, n in _SPAN.findall(attrs)}
    return tag == "th", min(max(span.get("col", 1), 1), _MAX_COLSPAN), span.get("row", 1)


class _Tables:
    """Collects every table's rows of cell texts and remembers the first
    table that is the parent of the movements element or of anything
    inside it.  ``where`` holds the places of the open elements by tag, so no
    step looks through all of them."""

    def __init__(self):
        self.open: list[str] = []          # open element tags
        self.where: dict[str, list[int]] = {tag: [-1] for tag in _PARTS}
        self.stack: list[_Table] = []      # open tables
        self.inside_target = 0             # depth of the movements element, 0 = not inside
        self.target: _Table | None = None
        self.done = False                  # the target is whole

    def handle_pieces(self, pieces: list[str], tags: dict) -> bool:
        """Texts and tokens in turns; False if the last one is a rest that is
        no token, unless the target was whole before.  The common cases are
        handled here, as the methods below do, all others by these."""
        open_, where, stack = self.open, self.where, self.stack
        tables, rows, cells = where["table"], where["tr"], (where["td"], where["th"])
        for text, piece in zip(pieces[::2], pieces[1::2]):
            if text and stack and (stack[-1].cell is not None or len(stack) > 1):
                self.handle_data(text)
            token = tags.get(piece)
            if token is None:
                token = _token(piece)
                if token is None:
                    return False
                if len(piece) <= _TAG_KEPT:
                    if len(tags) >= _TAGS_KEPT:
                        tags.clear()
                    tags[piece] = token
            tag, closing, ident, attrs, alone, kind = token
            if closing:
                places = where.get(tag)
                if not places:
                    continue
                if places[-1] == len(open_) - 1 >= 0 and tag != "table":
                    # the innermost element ends
                    open_.pop()
                    places.pop()
                    if stack:
                        if kind is not None:
                            stack[-1].end_cell()
                        elif tag == "tr":
                            stack[-1].end_row()
                    if self.inside_target > len(open_):
                        self.inside_target = 0
                    continue
                self.handle_endtag(tag)
                if self.done:
                    return True
            elif closing is not None:
                if alone or ident is not None or self.inside_target and self.target is None:
                    self.handle_starttag(tag, ident, attrs)
                    if alone:
                        self.handle_endtag(tag)
                elif tag not in _PARTS:
                    self._push(tag)
                elif stack and (kind is not None or tag == "tr"):
                    table, above = stack[-1], tables[-1]
                    i = max(cells[0][-1], cells[1][-1])
                    if i > above:
                        self._close(i)
                    if kind is None:
                        if rows[-1] > above:
                            self._close(rows[-1])
                        table.begin_row()
                        rows.append(len(open_))
                    else:
                        if table.row is None:
                            rows.append(len(open_))
                            open_.append("tr")
                            table.begin_row()
                        where[tag].append(len(open_))
                        table.cell, table.kind = [], kind
                    open_.append(tag)
                else:
                    self.handle_starttag(tag, ident, attrs)
        if pieces[-1]:
            self.handle_data(pieces[-1])
        return True

    def _last(self, *tags) -> int:
        """Place of the innermost open element of these tags, or -1."""
        last = -1
        for t in tags:
            places = self.where.get(t)
            if places and places[-1] > last:
                last = places[-1]
        return last

    def _push(self, tag):
        places = self.where.get(tag)
        if places is None:
            places = self.where[tag] = []
        places.append(len(self.open))
        self.open.append(tag)

    def handle_starttag(self, tag, ident, attrs=""):
        # an open cell, row or row group ends where the next one begins
        if self.stack and tag in _ENDS:
            table = self._last("table")
            for kinds in _ENDS[tag]:
                i = self._last(*kinds)
                if i > table:
                    self._close(i)
            if tag in _CELLS and self.stack[-1].row is None:
                self._push("tr")
                self.stack[-1].begin_row()
        if self.target is None and (ident == MOVEMENTS_ELEMENT_ID or self.inside_target):
            if self.open and self.open[-1] == "table" and self.stack:
                self.target = self.stack[-1]
        if ident == MOVEMENTS_ELEMENT_ID and not self.inside_target:
            self.inside_target = len(self.open) + 1
        self._push(tag)
        if tag == "table":
            self.stack.append(_Table())
        elif tag == "tr" and self.stack:
            self.stack[-1].begin_row()
        elif tag in _CELLS and self.stack:
            self.stack[-1].cell = []
            self.stack[-1].kind = _cell_kind(tag, attrs)

    def handle_endtag(self, tag):
        i = self._last(tag)
        # an end tag reaches no further than the table it stands in
        if i < 0 or tag != "table" and i < self._last("table"):
            return
        self._close(i)

    def _close(self, i: int):
        """Ends the open elements from the ``i``-th on."""
        while len(self.open) > i:
            self._pop()

    def _pop(self):
        tag = self.open.pop()
        self.where[tag].pop()
        if self.stack:
            if tag in _CELLS:
                self.stack[-1].end_cell()
            elif tag == "tr":
                self.stack[-1].end_row()
            elif tag == "table":
                inner = self.stack.pop()
                self.done = self.done or inner is self.target
                if self.stack:
                    self.stack[-1].add(inner.text)
        if self.inside_target and len(self.open) < self.inside_target:
            self.inside_target = 0

    def finish(self):
        while self.open:
            self._pop()

    def handle_data(self, data):
        if self.stack:
            table = self.stack[-1]
            data = _html.unescape(data) if "&" in data else data
            if len(self.stack) > 1:
                table.text.append(data)
            if table.cell is not None:
                table.cell.append(data)


def snake_names(names: list[str]) -> list[str]:
    """Snake-case header names; empty ones become ``x``; repeats get
    ``_2``, ``_3`` ..."""
    out, seen = [], {}
    for n in names:
        s = re.sub(r"[^0-9a-z]+", "_", n.strip().lower()).strip("_") or "x"
        if s in seen:
            seen[s] += 1
            s = f"{s}_{seen[s]}"
        else:
            seen[s] = 1
        out.append(s)
    return out


def _columns(names: tuple[str, ...]) -> tuple[int, int] | None:
    """Places of the date and text columns."""
    cols = snake_names(list(names))
    return (cols.index(DATE_COLUMN), cols.index(TEXT_COLUMN)) if DATE_COLUMN in cols and TEXT_COLUMN in cols else None


def movement_rows(html: str, seen: dict | None = None) -> list[tuple[str | None, str | None]]:
    """``(date text, movement text)`` per data row of the movements table.
    A page without that table, or a table without the two columns, raises.
    ``seen`` keeps what pages share, their tags and headers, for the next."""
    seen = {} if seen is None else seen
    p = _tables(html, seen.setdefault("tags", {}))
    if p.target is None:
        raise ValueError("page has no movement table")
    rows, heads = p.target.rows, p.target.heads
    if not rows:
        raise ValueError("movement table is empty")
    width = max(map(len, rows))
    if heads[0]:
        header, body = [_flat(c) for c in rows[0]], rows[1:]
    else:
        header, body = [f"X{i + 1}" for i in range(width)], rows
    names = (*header, *[""] * (width - len(header)))
    places = seen.get("header") == names and seen["places"] or _columns(names)
    if places is None:
        raise ValueError("movement table lacks date/text columns")
    seen["header"], seen["places"] = names, places
    di, ti = places
    return [(_flat(r[di]) if di < len(r) else None, _flat(r[ti]) if ti < len(r) else None) for r in body]


def _read(html, seen: dict) -> list[tuple[str | None, str | None]]:
    if html is None:
        raise ValueError("page has no content")
    return movement_rows(html if isinstance(html, str) else decode_page(bytes(html)), seen)


_ROWS_AT_ONCE = 50_000


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict = {}

    def made(pages, recs):
        # the page's own columns are copied as they are, by its place
        at, *cols = zip(*recs)
        text = pages.schema.field("file").type
        own = [pages.column(c).take(pa.array(at, pa.int32())) for c in ("file", "sg_date", "read")]
        return pa.RecordBatch.from_arrays([*own, *(pa.array(c, t) for c, t in zip(cols, (text, text, pa.int32(), text, text)))],
                                          ["file", "sg_date", "read", "return", "error", "pos", "movement_txt", "x3"])
    for pages in batches:
        recs = []
        for at, html in enumerate(pages.column("html").to_pylist()):
            try:
                rows = _read(html, seen)
                for i, (d, t) in enumerate(rows):
                    recs.append((at, "result", None, i, d, t))
                if not rows:  # readable page without movements: status row only
                    recs.append((at, "result", None, None, None, None))
            except Exception as e:  # per-page failure becomes a status row
                recs.append((at, "error", f"{type(e).__name__}: {e}", None, None, None))
            if len(recs) >= _ROWS_AT_ONCE:
                yield made(pages, recs)
                recs = []
        if recs:
            yield made(pages, recs)


def parse_pages(pages: DataFrame) -> DataFrame:
    """P1 + P5: ``(file, sg_date, html[, read])`` -> raw movement rows +
    status.  ``html`` is text, or the saved bytes in their own charset;
    ``read`` is when the page was saved, if that is known.  Each page gives one
    row with ``pos`` 0 or NULL, and more only if it has more movements."""
    read = F.col("read") if "read" in pages.columns else F.lit(None)
    return pages.select("file", "sg_date", read.cast("timestamp").alias("read"), "html").mapInArrow(_parse_batches, PARSED_SCHEMA)


def page_metrics() -> list:
    """P2 for ``DataFrame.observe`` on parsed rows: pages, unreadable pages
    and movement rows, counted by the job that passes the rows on."""
    return [F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("n_pages"),
            F.count_if(F.col("return") == "error").alias("n_error"), F.count("pos").alias("n_movements")]


def _status_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: dict = {}
    for pdf in batches:
        n = []
        for html in pdf["html"]:
            try:
                n.append(len(_read(html, seen)))
            except Exception:  # per-page failure becomes a status
                n.append(-1)
        yield pd.DataFrame({"sg_date": pdf["sg_date"], "n": pd.array(n, dtype="int64")})


def page_counts(pages: DataFrame) -> DataFrame:
    """P2 straight from pages: a number per page leaves Python, no rows."""
    n = pages.select("sg_date", "html").mapInPandas(_status_batches, "sg_date date, n long")
    return n.groupBy("sg_date").agg(F.count_if(F.col("n") < 0).cast("bigint").alias("n_error"),
                                    F.count_if(F.col("n") > 0).cast("bigint").alias("n_pages_with_rows"))


def parse_dmy(text) -> "F.Column":
    """Day, month and year in this order to DATE.  The month is a number or
    its English or Portuguese name (whole or its first three letters); parts
    are divided by anything but letters and digits (a month name also by
    nothing, and by ``de``), or written without a gap as six or eight digits.
    A two-digit year is 20yy up to 68 and 19yy from 69; anything else,
    including impossible dates, gives NULL."""
    text = col(text)
    d = F.lower(unaccent(squish(text)))
    plain = F.concat_ws("-", *(F.substring(text, at, n) for at, n in ((7, 4), (4, 2), (1, 2))))

    def part(pattern, k):
        return F.when(d.rlike(pattern), F.regexp_extract(d, pattern, k))

    months = F.create_map(*[F.lit(x) for n, names in enumerate(MONTH_NAMES, 1) for name in names for x in (name, str(n))])
    forms = [(_NUMBERS, lambda m: m), (_NAMED, lambda m: F.try_element_at(months, m)), (_JOINED, lambda m: m)]
    day = F.coalesce(*(part(p, 1) for p, _ in forms))
    month = F.coalesce(*(number(part(p, 2)) for p, number in forms))
    year = F.coalesce(*(part(p, 3) for p, _ in forms))
    century = F.when(F.length(year) > 2, "").when(year.cast("int") <= TWO_DIGIT_PIVOT, "20").otherwise("19")
    any_form = F.try_to_date(F.concat(day, F.lit("/"), month, F.lit("/"), century, year), DATE_FORMAT)
    # the usual form is told by one pattern and read without a formatter
    return F.when(text.rlike(_USUAL), plain.try_cast("date")).otherwise(any_form)


def _kept():
    """Rows of readable pages whose date text is not empty (P6)."""
    return (F.col("return") != "error") & F.col("pos").isNotNull() & (F.col("movement_txt") != "")


def tidy_columns(parsed: DataFrame) -> DataFrame:
    """Parsed rows with ``movement``, ``title`` and ``txt`` (P7-P9)."""
    return parsed.withColumns({
        "movement": parse_dmy(F.col("movement_txt")), "title": squish(split_get("x3", TITLE_SEP, 2, 0)),
        "txt": squish(split_get("x3", TITLE_SEP, 2, 1))})


def tidy_movements(parsed: DataFrame) -> DataFrame:
    """P6-P9 on parsed rows of readable pages."""
    return tidy_columns(parsed.filter(_kept())).select("file", "sg_date", "pos", "movement", "title", "txt")


def nested_movements(parsed: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per saved page (``file, sg_date, read``): ``page_return`` and
    its movements as the record holds them (``movs``, in page order), dealt by
    file to so many ``tasks``, if given."""
    row = F.struct("pos", "movement", "title", "txt")
    dealt = parsed.repartition(tasks, "file") if tasks else parsed.repartition("file")
    kept = tidy_columns(dealt).withColumn("_row", F.when(_kept(), row))
    movs = F.transform(F.array_sort(F.collect_list("_row")),
                       lambda x: F.struct(x["movement"].alias("movement"), x["title"].alias("title"), x["txt"].alias("txt")))
    return kept.groupBy("file", "sg_date", "read").agg(
        F.max_by("return", F.col("return") == "error").alias("page_return"), movs.alias("movs"))


def chosen_pages(parsed: DataFrame, by_day: bool, as_of=None, tasks: int | None = None) -> DataFrame:
    """One page for each file (and day, if ``by_day``): the one of the newest
    day, then read last, as of the end of the day ``as_of`` if given.  Pages
    read at one time are one page."""
    pages = nested_movements(parsed, tasks)
    if as_of is not None:
        pages = pages.where(F.col("sg_date").isNull() | (F.col("sg_date") <= F.lit(str(as_of)).cast("date")))
    keys = ["file", "sg_date"] if by_day else ["file"]
    order = F.struct(F.col("sg_date").isNotNull(), "sg_date", F.col("read").isNotNull(), "read")
    best = pages.groupBy(*keys).agg(F.max_by(F.struct("sg_date", "page_return", "movs"), order).alias("_p"))
    return best.select("file", "_p.*")


def merge_movements(cases: DataFrame, parsed: DataFrame, as_of=None) -> DataFrame:
    """Case records with the movements of one of their pages and that page's
    day: of the record's own day if records have a day (``sg_date``), else the
    newest, as of a day if one is given.  A record never stands twice for a
    page that was saved twice.  A page that cannot be read makes its record an
    error; a record without a page keeps what it has.  Pages and records meet
    in tasks that grow with the records."""
    by_day = "sg_date" in cases.columns
    tasks = case_tasks(cases)
    few = tasks <= int(cases.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # Spark may then join them
    pages = chosen_pages(parsed, by_day, as_of, None if few else tasks)
    on = F.col("file") == F.col("_file")
    if by_day:
        pages = pages.withColumnRenamed("sg_date", "_day")
        on = on & F.col("sg_date").eqNullSafe(F.col("_day"))
    both = cases.join(pages.withColumnRenamed("file", "_file"), on, "left")
    empty = F.array().cast(cases.schema["output"].dataType["movs"].dataType)
    movs = F.when(F.col("page_return").isNull(), F.col("output.movs")).otherwise(F.coalesce("movs", empty))
    status = F.when(F.col("page_return") == "error", F.lit("error")).otherwise(F.col("return"))
    rest = [c for c in cases.columns if c not in ("return", "output", "sg_date")]
    return both.select(*rest, status.alias("return"), F.col("output").withField("movs", movs).alias("output"), "sg_date")
