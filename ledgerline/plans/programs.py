"""Small query programs: a described Python function over run_query and the catalog.

The checks keep mistakes out. They are no sandbox: run only programs whose author you trust.
"""

from __future__ import annotations

import ast
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerline.functions.arguments import bounded_limit, comparison, literal, program_name, quoted_name, safe_identifier, table_argument
from ledgerline.operators.filters import known_column
from ledgerline.plans.catalog import Catalog
from ledgerline.plans.guarded import rows_within, run_query

MOST_SOURCE = 30_000
#: Names a program may not use.
FORBIDDEN = frozenset("open exec eval compile __import__ input globals locals vars getattr setattr delattr breakpoint os sys subprocess socket shutil pathlib requests urllib importlib".split())


@dataclass
class Program:
    name: str
    description: str
    handler: Callable
    input_schema: dict = field(default_factory=lambda: {"type": "object", "properties": {}})


class Result:
    """What a query gave: its columns and rows, and nothing of the session."""

    __slots__ = ("_frame",)

    def __init__(self, frame: DataFrame):
        self._frame = frame

    @property
    def columns(self) -> list[str]:
        return self._frame.columns

    def limit(self, n: object) -> Result:
        return Result(self._frame.limit(bounded_limit(n)))

    def collect(self) -> list[dict]:
        """The rows as dictionaries, within the time that queries have."""
        return [r.asDict() for r in rows_within(self._frame)]

    def __iter__(self):
        return iter(self.collect())


class Helpers:
    """What programs get besides run_query: the catalog's answers as plain values, and checks of arguments."""

    bounded_limit = staticmethod(bounded_limit)
    comparison = staticmethod(comparison)
    safe_identifier = staticmethod(safe_identifier)
    table_argument = staticmethod(table_argument)
    quoted_name = staticmethod(quoted_name)
    quoted_text = staticmethod(lambda value: literal(str(value)))
    literal = staticmethod(literal)

    def __init__(self, spark: SparkSession):
        self._catalog = Catalog(spark)

    def list_tables(self, views: bool = True) -> list[dict]:
        return self._catalog.tables(views)

    def schema(self, views: bool = True) -> list[dict]:
        return self._catalog.schema(views)

    def schema_for_question(self, question: str) -> list[dict]:
        return self._catalog.for_question(question)

    def table_exists(self, table: str) -> str:
        """The table's name, or an error."""
        if not self._catalog.exists(table):
            raise ValueError(f"unknown table {table!r}")
        return safe_identifier(table)

    def columns(self, table: str) -> list[dict]:
        return self._catalog.columns(table)

    def column_exists(self, table: str, column: str) -> str:
        """The column's name, or an error."""
        return known_column(self._catalog.table(table), column)

    def sample(self, table: str, limit: object = None) -> Result:
        return Result(self._catalog.sample(table, limit))

    def count_by(self, table: str, dimensions: list[str], equal: dict | None = None, compare: list[dict] | None = None, limit: object = None) -> Result:
        return Result(self._catalog.count_by(table, dimensions, equal, compare, limit))


#: Helpers of which a program that names tables of the platform's database must use one.
COLUMN_CHECKS = frozenset(["columns", "column_exists"])


def checked(source: str, database: str = "analytics") -> ast.Module:
    """The parsed source, if it has CONNECTOR and handler, imports nothing and uses no forbidden or private name.

    A program that queries tables as ``database.table`` must look their columns up through the helpers.
    """
    if len(source) > MOST_SOURCE:
        raise ValueError(f"a program has at most {MOST_SOURCE} characters")
    if "\n" not in source and "\\n" in source:
        source = source.replace("\\n", "\n").replace("\\t", "    ")
    try:
        tree = ast.parse(source)
    except SyntaxError as e:
        raise ValueError(f"not Python: {e.msg}") from None
    names, attributes, texts = set(), set(), []
    for node in ast.walk(tree):
        if isinstance(node, (ast.Import, ast.ImportFrom)):
            raise ValueError("a program imports nothing")
        if isinstance(node, ast.Name):
            names.add(node.id)
        elif isinstance(node, ast.Attribute):
            attributes.add(node.attr)
        elif isinstance(node, ast.Constant) and isinstance(node.value, str):
            texts.append(node.value)
    refused = (names | attributes) & FORBIDDEN | {n for n in names if n.startswith("__")} | {a for a in attributes if a.startswith("_")}
    if refused:
        raise ValueError(f"not allowed in a program: {', '.join(sorted(refused))}")
    defined = {n.name for n in tree.body if isinstance(n, ast.FunctionDef)}
    assigned = {t.id for n in tree.body if isinstance(n, ast.Assign) for t in n.targets if isinstance(t, ast.Name)}
    if "handler" not in defined or "CONNECTOR" not in assigned:
        raise ValueError("a program defines CONNECTOR and handler(args, run_query, helpers)")
    if "run_query" in names and any(f"{database}." in t for t in texts) and not attributes & COLUMN_CHECKS:
        raise ValueError(f"a program over {database} checks its columns with helpers.{' or helpers.'.join(sorted(COLUMN_CHECKS))}")
    return tree


class Programs:
    """Programs by name."""

    def __init__(self, spark: SparkSession, prefix: str = "query_"):
        self._spark, self.prefix, self.known = spark, prefix, {}

    def create(self, source: str, overwrite: bool = False, name: str | None = None) -> Program:
        """Checks and keeps a program. ``name``, if given, must be the one that the program has."""
        allowed = {"len": len, "min": min, "max": max, "sum": sum, "sorted": sorted, "range": range, "int": int, "float": float, "str": str, "list": list, "dict": dict, "enumerate": enumerate, "zip": zip, "round": round, "isinstance": isinstance, "ValueError": ValueError, "abs": abs, "set": set, "tuple": tuple, "bool": bool}
        space: dict = {"__builtins__": allowed}
        exec(compile(checked(source), "<program>", "exec"), space)
        about = space["CONNECTOR"]
        if not isinstance(about, dict) or len(str(about.get("description") or "")) < 10:
            raise ValueError("CONNECTOR needs a description of ten characters or more")
        schema = about.get("input_schema", about.get("inputSchema")) or {"type": "object", "properties": {}}
        if not isinstance(schema, dict) or schema.get("type", "object") != "object":
            raise ValueError("input_schema describes an object")
        own = program_name(about.get("name"), self.prefix)
        if name is not None and program_name(name, self.prefix) != own:
            raise ValueError(f"the program calls itself {own!r}, not {name!r}")
        name = own
        if name in self.known and not overwrite:
            raise ValueError(f"there is a program {name!r}")
        self.known[name] = Program(name, about["description"], space["handler"], schema)
        return self.known[name]

    def update(self, name: str, source: str) -> Program:
        """Replaces a program that is there."""
        if name not in self.known:
            raise ValueError(f"no program {name!r}")
        return self.create(source, overwrite=True, name=name)

    def run(self, name: str, args: dict | None = None):
        if name not in self.known:
            raise ValueError(f"no program {name!r}")
        return self.known[name].handler(args or {}, lambda q, **p: Result(run_query(self._spark, q, p)), Helpers(self._spark))

    def run_once(self, source: str, args: dict | None = None):
        """Creates a program, runs it and forgets it, whatever happens; one of the same name is as before."""
        once = Programs(self._spark, self.prefix)
        return once.run(once.create(source).name, args)
