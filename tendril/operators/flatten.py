"""Nested notice documents to flat columns.

Two ways with the same result: ``flatten_any`` keeps every path of a document it has never seen (a Python
helper over Arrow batches), ``flatten_declared`` reads a known list of paths with Spark's own XML parser and stays in the JVM.

A path joins element and attribute names with ``__``. Paragraph elements (P) count towards their parent's path, font
elements (FT) are dropped together with their text, empty elements give nothing, and the values of one path keep
document order.
"""

from __future__ import annotations

from xml.parsers import expat

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from .ordered import col

SEP = "__"
PATHS = "map<string,array<string>>"
HEADER_SECTIONS = ("CODIF_DATA", "NOTICE_DATA")
SKIPPED = ("URI_LIST",)
MOST_STEPS = 100_000  # places of documents that a task remembers


class _Step:
    """An element at its place in a document: what becomes of its text and attributes, and the elements met below it."""

    __slots__ = ("label", "live", "path", "text", "fills", "below", "keys", "wanted")

    def __init__(self, wanted: frozenset | None, label: str | None, path: str | None = None, text: str | None = None, fills: str | None = None):
        self.wanted, self.label, self.live, self.path, self.fills = wanted, label, path is not None, path, fills
        self.text = text if text and (wanted is None or text in wanted) else None
        self.below: dict[str, _Step] = {}
        self.keys: dict[str, str | None] = {}

    def grow(self, name: str) -> _Step:
        wanted = self.wanted
        if self.live:
            path = self.path + SEP + name if self.path else name
            own = self.path if name == "P" else path
            # a dropped element hides the names below it, and so does one that no wanted path leads through
            if name == "FT" or name in SKIPPED:
                made = _Step(wanted, "FT")
            elif wanted is None or own in wanted or path in wanted or any(w.startswith(path + SEP) for w in wanted):
                made = _Step(wanted, name, path, own)
            else:
                made = _Step(wanted, "FT")
        elif self.label == "CODED_DATA_SECTION" and name in HEADER_SECTIONS:
            made = _Step(wanted, name, "", fills="header")
        elif self.label == "FORM_SECTION":
            made = _Step(wanted, name, "", fills="form")
        else:
            made = _Step(wanted, None if self.label in ("FT", *SKIPPED, None) else name)
        self.below[name] = made
        return made

    def key(self, name: str) -> str | None:
        path = self.path + SEP + name if self.path else name
        self.keys[name] = found = path if self.wanted is None or path in self.wanted else None
        return found


class _Scanner:
    """Documents to maps of values by path; the places met are remembered from one document to the next."""

    def __init__(self, wanted: frozenset | None):
        self.wanted, self.met = wanted, 0
        self.root = _Step(wanted, "")

    def __call__(self, text: str) -> tuple[dict, list[dict]]:
        """Header and form path maps of one document, in one pass over its tags."""
        header, forms = {}, []
        if self.met > MOST_STEPS:
            self.root, self.met = _Step(self.wanted, ""), 0
        stack = [(self.root, None, None)]  # (place, map it fills, text pieces)

        def start(name, attrs):
            parent, out, _ = stack[-1]
            step = parent.below.get(name)
            if step is None:
                step = parent.grow(name)
                self.met += 1
            if not step.live:
                stack.append((step, None, None))
                return
            if step.fills:
                out = header
                if step.fills == "form":
                    out = {}
                    forms.append(out)
            stack.append((step, out, [] if step.text else None))
            for key, value in attrs.items():
                path = step.keys[key] if key in step.keys else step.key(key)
                if path and value:
                    out.setdefault(path, []).append(value)

        def data(piece):
            pieces = stack[-1][2]
            if pieces is not None:
                pieces.append(piece)

        def end(_):
            step, out, pieces = stack.pop()
            if pieces:
                value = "".join(pieces).strip()
                if value:
                    out.setdefault(step.text, []).append(value)

        parser = expat.ParserCreate()
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, data
        parser.Parse(text, True)
        return header, forms


def _scan(text: str, wanted: frozenset | None) -> tuple[dict, list[dict]]:
    return _Scanner(wanted)(text)


def flatten_any(docs: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """file, date, header, forms and error of each document, each parsed once; ``paths`` drops all else in the helper."""
    wanted = frozenset(paths) if paths is not None else None

    def flat(batches):
        import pyarrow as pa

        items = pa.map_(pa.string(), pa.list_(pa.string()))
        scan = _Scanner(wanted)
        for batch in batches:
            headers, forms, errors = [], [], []
            for doc in batch.column("value").to_pylist():
                try:
                    header, found = scan(doc)
                    headers.append(list(header.items()))
                    forms.append([list(form.items()) for form in found])
                    errors.append(None)
                except (expat.ExpatError, TypeError) as problem:
                    headers.append(None)
                    forms.append(None)
                    errors.append(str(problem))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("date"), pa.array(headers, items), pa.array(forms, pa.list_(items)), pa.array(errors, pa.string())],
                ["file", "date", "header", "forms", "error"])

    return docs.select("file", "date", "value").mapInArrow(flat, f"file string, date string, header {PATHS}, forms array<{PATHS}>, error string")


def document_type(text: Column) -> Column:
    """Document type read straight from the text, so that unwanted documents are dropped before they are parsed."""
    found = F.trim(F.regexp_extract(text, r"<TD_DOCUMENT_TYPE(?:\s[^>]*)?>([^<]*)<", 1))
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        found = F.replace(found, F.lit(entity), F.lit(char))
    return found


def pick_language(df: DataFrame, language: str | None = "EN", strict: bool = False, forms: str = "forms") -> DataFrame:
    """One row per chosen form: those in ``language``, and a document's only form whatever its language.

    ``strict`` tests single forms too; ``language=None`` keeps all. Adds ``form`` and ``form_no``.
    """
    rows = df.select("*", F.posexplode(col(forms)).alias("form_no", "form"))
    if language is None:
        return rows
    same = F.coalesce(F.get(F.col("form")["LG"], 0) == language, F.lit(False))
    return rows.filter(same if strict else (F.size(col(forms)) == 1) | same)


def path_values(path: str) -> Column:
    """All values of a path in header and form, header first; null if there is none."""
    both = F.concat(*[F.coalesce(F.try_element_at(F.col(part), F.lit(path)), F.array().cast("array<string>")) for part in ("header", "form")])
    return F.when(F.size(both) > 0, both)


def _tree(paths: list[str]) -> dict:
    root: dict = {}
    for path in paths:
        node = root
        for step in path.split(SEP):
            node = node.setdefault(step, {})
    return root


def declared_type(paths: list[str]) -> T.StructType:
    """Reader schema covering the paths: any last step may be an attribute or an element, any element may repeat."""

    def struct(node: dict, top: bool = False) -> T.StructType:
        fields = [] if top else [T.StructField("text", T.StringType())]
        if not top and "P" not in node:
            fields.append(T.StructField("P", T.ArrayType(T.StringType())))
        for name, child in node.items():
            if not child:
                fields.append(T.StructField("_" + name, T.StringType()))
            fields.append(T.StructField(name, T.ArrayType(struct(child))))
        return T.StructType(fields)

    return struct(_tree(paths), top=True)


def _leaves(node: Column, kind: T.StructType, steps: list[str]) -> list[Column]:
    """Array columns that together hold a path's values below an array of structs."""
    step, rest = steps[0], steps[1:]
    names = kind.fieldNames()
    out = []
    if not rest and "_" + step in names:
        out.append(F.transform(node, lambda s: s["_" + step]))
    child_kind = kind[step].dataType.elementType
    child = F.flatten(F.filter(F.transform(node, lambda s: s[step]), lambda a: a.isNotNull()))
    if rest:
        return out + _leaves(child, child_kind, rest)
    out.append(F.transform(child, lambda s: s["text"]))
    inner = child_kind["P"].dataType.elementType if "P" in child_kind.fieldNames() else None
    if isinstance(inner, T.StringType):
        out.append(F.flatten(F.filter(F.transform(child, lambda s: s["P"]), lambda a: a.isNotNull())))
    elif inner is not None:
        out.append(F.flatten(F.filter(F.transform(child, lambda s: s["P"]["text"]), lambda a: a.isNotNull())))
    return out


def declared_values(node: Column, kind: T.StructType, path: str) -> Column:
    """Values of one path below a parsed column (an array of ``kind`` structs)."""
    found = F.concat(*_leaves(node, kind, path.split(SEP)))
    clean = F.transform(found, lambda v: F.trim(F.regexp_replace(v, r"(?s)<FT\b[^>]*?(/>|>.*?</FT>)", "")))
    kept = F.filter(clean, lambda v: v.isNotNull() & (v != ""))
    return F.when(F.size(kept) > 0, kept)


def flatten_declared(text: Column, sections: dict[str, list[str]], form_types: list[str]) -> tuple[Column, T.StructType]:
    """Parsed document column for the header paths per section and the form paths under the given form types.

    ``sections`` maps 'CODIF_DATA', 'NOTICE_DATA' and 'FORM' to their paths.
    """
    form = declared_type(sections["FORM"])
    coded = T.StructType([T.StructField(s, T.ArrayType(declared_type(sections[s]))) for s in HEADER_SECTIONS])
    kind = T.StructType([
        T.StructField("CODED_DATA_SECTION", coded),
        T.StructField("FORM_SECTION", T.StructType([T.StructField(f, T.ArrayType(form)) for f in form_types])),
    ])
    return F.from_xml(text, kind, {"valueTag": "text", "attributePrefix": "_", "mode": "PERMISSIVE"}), kind


def notice_rows(
    docs: DataFrame, language: str | None = "EN", types: list[str] | None = None, paths: list[str] | None = None, strict: bool = False
) -> DataFrame:
    """Flattened notices: one row per chosen form of each document of a wanted type.

    ``docs`` has ``file`` (name), ``date`` (yyyymmdd) and ``value`` (text). Result: file, date, header, form_no, form.
    Documents that cannot be parsed are left out; ``broken_documents`` lists them.
    """
    types = S.DOCUMENT_TYPES if types is None else types
    kept = docs.filter(document_type(col("value")).isin(types)) if types else docs
    wanted = None if paths is None else [*paths, "LG", "TD_DOCUMENT_TYPE"]
    rows = flatten_any(kept, wanted).filter("error is null").drop("error")
    return pick_language(rows, language, strict).drop("forms")


def notice_columns(docs: DataFrame, paths: list[str], language: str | None = "EN", types: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Like ``notice_rows`` for a known list of paths: one list column per path, header values before the form's.

    The paths become columns inside the helper, so no map travels through the plan and later projections stay cheap.
    """
    types = S.DOCUMENT_TYPES if types is None else types
    kept = docs.filter(document_type(col("value")).isin(types)) if types else docs
    names = list(dict.fromkeys(paths))
    wanted = frozenset([*names, "LG"])

    def flat(batches):
        import pyarrow as pa

        texts = pa.list_(pa.string())
        scan = _Scanner(wanted)
        for batch in batches:
            source, number, total, language_, cells = [], [], [], [], [[] for _ in names]
            for i, doc in enumerate(batch.column("value").to_pylist()):
                try:
                    header, forms = scan(doc)
                except (expat.ExpatError, TypeError):
                    continue
                for k, form in enumerate(forms):
                    source.append(i)
                    number.append(k)
                    total.append(len(forms))
                    language_.append(form.get("LG", [None])[0])
                    for column, name in zip(cells, names):
                        head, own = header.get(name), form.get(name)
                        column.append(head + own if head and own else head or own)
            picked = batch.select(["file", "date"]).take(pa.array(source, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(number, pa.int32()), pa.array(total, pa.int32()), pa.array(language_, pa.string()), *[pa.array(c, texts) for c in cells]],
                ["file", "date", "form_no", "n_forms", "_lg", *names])

    kind = T.StructType([
        T.StructField("file", T.StringType()), T.StructField("date", T.StringType()), T.StructField("form_no", T.IntegerType()),
        T.StructField("n_forms", T.IntegerType()), T.StructField("_lg", T.StringType()), *[T.StructField(n, T.ArrayType(T.StringType())) for n in names]])
    rows = kept.select("file", "date", "value").mapInArrow(flat, kind)
    if language is not None:
        same = F.coalesce(col("_lg") == language, F.lit(False))
        rows = rows.filter(same if strict else (col("n_forms") == 1) | same)
    return rows.drop("n_forms", "_lg")


def broken_documents(docs: DataFrame) -> DataFrame:
    """Documents the parser rejects, with its message."""
    return flatten_any(docs, []).filter("error is not null").select("file", "date", "error")


def shallow(df: DataFrame, columns: list[str]) -> DataFrame:
    """One level of structs: the text keeps the name, CODE becomes name_CODE; arrays give parallel arrays."""
    out = []
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            out += [F.transform(col(c), lambda s: s["text"]).alias(c), F.transform(col(c), lambda s: s["_CODE"]).alias(c + "_CODE")]
        elif isinstance(kind, T.StructType):
            out += [col(c)["text"].alias(c), col(c)["_CODE"].alias(c + "_CODE")]
        else:
            out.append(col(c))
    return df.select(*[col(c) for c in df.columns if c not in columns], *out)


def section(df: DataFrame, struct: str, extra: dict[str, Column]) -> DataFrame:
    """Fields of a struct under lower-cased names, plus named extras."""
    fields = [col(struct)[f].alias(f.lower()) for f in df.schema[struct].dataType.fieldNames()]
    return df.select(*[col(c) for c in df.columns if c != struct], *fields, *[v.alias(n) for n, v in extra.items()])


def joined_paragraphs(values: Column) -> Column:
    """All paragraphs of a value as one text."""
    return F.array_join(values, " ")
