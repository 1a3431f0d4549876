"""Spreadsheet files without a spreadsheet library: the first sheet of an .xlsx with inferred types, and plain writers.

An .xlsx file is one zip archive, so each file is read by one task; many files are read in parallel.
"""

from __future__ import annotations

import datetime
import io
import os
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palmleaf.functions.text import NA_TEXTS as NA

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """The cell styles that show a number as a date: built-in formats, and own ones that name a year or a day."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(_NS + "numFmt")}
    dates = {*range(14, 23), *range(45, 48)} | {k for k, code in own.items() if re.search("[yd]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", code), re.I)}
    cells = root.find(_NS + "cellXfs")
    return {k for k, x in enumerate(cells if cells is not None else ()) if int(x.get("numFmtId", 0)) in dates}


def _when(serial: str) -> str:
    """A day number of the 1900 calendar as a time."""
    return (datetime.datetime(1899, 12, 30) + datetime.timedelta(seconds=round(float(serial) * 86400))).isoformat(" ")


def rows(content: bytes) -> Iterator[list[tuple[str, str] | None]]:
    """The rows of the first sheet: the type and text of each cell; an empty cell is None. Types are those of TYPES."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in si.iter(_NS + "t")))
        dates = _date_styles(z)
        sheet = min((n for n in names if n.startswith("xl/worksheets/sheet")), key=lambda n: (len(n), n))
        with z.open(sheet) as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag != _NS + "row":
                    continue
                out: list[tuple[str, str] | None] = []
                for k, c in enumerate(row.findall(_NS + "c")):
                    at = _column(c.get("r")) if c.get("r") else k
                    out += [None] * (at - len(out) + 1)
                    kind, v = c.get("t", "n"), c.find(_NS + "v")
                    if kind == "inlineStr":
                        out[at] = ("string", "".join(t.text or "" for t in c.iter(_NS + "t")))
                    elif v is None or v.text is None:
                        continue
                    elif kind == "b":
                        out[at] = ("boolean", {"0": "false", "1": "true"}[v.text])
                    elif kind != "n":
                        out[at] = ("string", shared[int(v.text)] if kind == "s" else v.text)
                    elif int(c.get("s", 0)) in dates:
                        out[at] = ("timestamp", _when(v.text))
                    else:
                        whole = re.fullmatch(r"-?\d{1,18}(\.0+)?", v.text)
                        out[at] = ("bigint", v.text.split(".")[0]) if whole else ("double", v.text)
                yield out
                row.clear()


TYPES = ("string", "double", "bigint", "boolean", "timestamp")


def _type(seen: set[str]) -> str:
    """The type of a column that holds these; anything mixed but whole and broken numbers is text."""
    if seen == {"bigint", "double"}:
        return "double"
    return seen.pop() if len(seen) == 1 else "string"


def read(spark: SparkSession, path: str, infer: bool = True) -> DataFrame:
    """(file, pos, one column per header): the header of the first file in name order holds for all. Headers are trimmed.

    Types are inferred over all cells of all files (numbers, booleans, times, else text), in a pass of its own; texts that
    stand for a missing value and empty cells are null. Without infer every column is text, as written.
    """
    files = spark.read.format("binaryFile").load(path)
    first = files.select("path").agg(F.min("path")).first()[0]
    if first is None:
        raise FileNotFoundError(path)
    head = files.filter(F.col("path") == first).select("content").first()  # one file
    names = [((h[1] if h else "") or f"column_{k}").strip() for k, h in enumerate(next(rows(bytes(head[0])), []))]
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("pos", T.LongType()), *(T.StructField(n, T.StringType()) for n in names)])

    def bodies(pdf):
        for where, content in zip(pdf["path"], pdf["content"]):
            body = rows(bytes(content))
            next(body, None)
            yield where, body

    def kinds(batches):
        import pandas as pd

        for pdf in batches:
            seen = {(k, c[0]) for _, body in bodies(pdf) for r in body for k, c in enumerate(r[: len(names)]) if c and c[1] not in NA}
            yield pd.DataFrame(sorted(seen), columns=["k", "kind"])

    def parse(batches):
        import pandas as pd

        for pdf in batches:
            for where, body in bodies(pdf):
                lines: list[list] = []
                for k, r in enumerate(body):
                    cells = [None if not c or infer and c[1] in NA else c[1] for c in r[: len(names)]]
                    lines.append([where, k, *cells, *[None] * (len(names) - len(cells))])
                    if len(lines) == 10_000:
                        yield pd.DataFrame(lines, columns=["file", "pos", *names])
                        lines = []
                yield pd.DataFrame(lines, columns=["file", "pos", *names])

    text = files.select("path", "content").mapInPandas(parse, schema)
    if not infer:
        return text
    seen: dict[int, set] = {}
    for r in files.select("path", "content").mapInPandas(kinds, "k INT, kind STRING").distinct().collect():  # columns x types
        seen.setdefault(r["k"], set()).add(r["kind"])
    types = ["string", "bigint", *(_type(seen.get(k, set())) for k in range(len(names)))]
    return text.toDF(*(f"c{k}" for k in range(len(types)))).select(*(F.col(f"c{k}").cast(t).alias(n) for k, (t, n) in enumerate(zip(types, ["file", "pos", *names]))))


SHEET_ROWS = 1_048_575  # what a sheet holds below its header


def _cell(v) -> str:
    if v is None:
        return "<c/>"
    if isinstance(v, bool):
        return f'<c t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)) and abs(v) < 1e15:
        return f"<c><v>{v!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'


def _sheet(path: str, header: list[str], body) -> int:
    """Writes the rows as they come; returns how many."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pack = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    n = 0
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'<Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{pack}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Sheet1" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{pack}/relationships"><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'<worksheet xmlns="{main}"><sheetData><row>{"".join(map(_cell, header))}</row>'.encode())
            for r in body:
                n += 1
                if n > SHEET_ROWS:
                    raise ValueError(f"a sheet holds {SHEET_ROWS} rows")
                f.write(f"<row>{''.join(map(_cell, r))}</row>".encode("utf-8", "surrogatepass"))
            f.write(b"</sheetData></worksheet>")
    return n


def write(df: DataFrame, path: str) -> int:
    """One local sheet without an index, for reports that people open; missing folders are made. Rows stream through the
    driver one partition at a time; more than a sheet holds is an error."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    return _sheet(path, df.columns, df.toLocalIterator())


def write_parts(df: DataFrame, path: str, sheet_rows: int = SHEET_ROWS) -> int:
    """A folder of sheets that the executors write, each task its own ones of at most sheet_rows rows, into a folder they
    all share (a plain path or file:). Returns the rows written. A task that runs again writes the same names again."""
    folder = path.removeprefix("file:")
    header = df.columns

    def run(batches):
        import itertools

        import pandas as pd
        from pyspark import TaskContext

        os.makedirs(folder, exist_ok=True)
        pid, no, total = TaskContext.get().partitionId(), 0, 0
        values = (tuple(None if v is None or v != v else v.item() if hasattr(v, "item") else v for v in r) for pdf in batches for r in pdf.astype(object).itertuples(index=False, name=None))
        while True:
            first = next(values, None)
            if first is None:
                break
            name = f"{folder}/part-{pid:05d}-{no:03d}.xlsx"
            total += _sheet(f"{name}.tmp", header, itertools.chain([first], itertools.islice(values, sheet_rows - 1)))
            os.replace(f"{name}.tmp", name)
            no += 1
        yield pd.DataFrame({"n": [total]})

    return df.mapInPandas(run, "n BIGINT").agg(F.sum("n")).first()[0] or 0
