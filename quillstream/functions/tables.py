"""Table rows as arrays of cells and grids as arrays of rows, as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .markdown import is_numeric, table_cell
from .text import blank, collapse, strip

MANGLED = r"(?:^|\s)[a-z]?_[0-9A-Za-z]"


def parse_row(line: Column) -> Column:
    """Cells of a row; blank ones before the first bar and after the last are no cells."""
    parts = F.split(line, r"\|")
    parts = F.when(blank(F.element_at(parts, 1)), F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)
    parts = F.when((F.size(parts) > 0) & blank(F.try_element_at(parts, F.lit(-1))), F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)
    return F.transform(parts, strip)


def bare_cells(line: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(strip(line), r"^\|+|\|+$", ""), r"\|"), strip)


def header_key(cells: Column) -> Column:
    return F.array_join(F.transform(cells, lambda c: F.lower(F.regexp_replace(F.regexp_replace(strip(c), r"^\*+|\*+$", ""), r"(?U)\s+", " "))), "|")


def is_fragment(cells: Column) -> Column:
    """Three cells or more, the first two blank, a later one not."""
    return (F.size(cells) >= 3) & blank(cells[0]) & blank(cells[1]) & F.exists(F.slice(cells, F.lit(3), F.greatest(F.size(cells) - 2, F.lit(0))), lambda c: ~blank(c))


def wide(row: Column, columns: Column) -> Column:
    return F.concat(row, F.array_repeat(F.lit(""), F.greatest(columns - F.size(row), F.lit(0))))


def columns(grid: Column) -> Column:
    return F.array_max(F.transform(grid, F.size))


def header_rows(grid: Column) -> Column:
    """2 if the top row has blanks, the second begins with one and fills one of the first; else 1. What a
    ragged row lacks is blank."""
    top, sub = F.try_element_at(grid, F.lit(1)), F.try_element_at(grid, F.lit(2))
    fills = F.exists(F.arrays_zip(top.alias("a"), sub.alias("b")), lambda p: blank(p["a"]) & ~blank(p["b"]))
    two = blank(F.try_element_at(sub, F.lit(1))) & fills
    return F.when((F.size(grid) >= 2) & F.coalesce(two, F.lit(False)), 2).otherwise(1)


def is_mangled(row: Column) -> Column:
    return F.exists(row, lambda c: c.rlike(MANGLED))


def header_mangled(grid: Column) -> Column:
    return F.exists(F.slice(grid, F.lit(1), header_rows(grid)), is_mangled)


def well_formed(grid: Column, least_fill: float = 0.4) -> Column:
    cells = F.flatten(grid)
    filled = F.size(F.filter(cells, lambda c: ~blank(c)))
    data = F.slice(grid, header_rows(grid) + 1, F.greatest(F.size(grid) - header_rows(grid), F.lit(0)))
    return (
        (F.size(grid) >= 2)
        & (F.size(F.array_distinct(F.transform(grid, F.size))) == 1)
        & (F.size(grid[0]) >= 2)
        & (filled / F.greatest(F.size(cells), F.lit(1)) >= least_fill)
        & ~F.exists(data, is_mangled)
    )


def at(row: Column, j: Column) -> Column:
    return F.coalesce(F.try_element_at(row, j + 1), F.lit(""))


def step_into(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A named step: expressions that use a step often stay small, as Catalyst doesn't copy it into them."""
    return df.withColumn(name, value)


def merge_fragments(df: DataFrame, grid: str, joint: str = "<br>") -> DataFrame:
    """``df`` with each fragment row of the grid folded into the data row above it, if that one's first
    cell is not blank."""

    def folded(last: Column, row: Column) -> Column:
        padded = F.arrays_zip(wide(last, F.size(row)).alias("a"), wide(row, F.size(last)).alias("b"))
        return F.transform(padded, lambda p: F.when(blank(p["b"]), p["a"]).when(blank(p["a"]), strip(p["b"])).otherwise(F.concat(strip(p["a"]), F.lit(joint), strip(p["b"]))))

    def step(done: Column, row: Column) -> Column:
        last = F.coalesce(F.try_element_at(done, F.lit(-1)), F.array().cast("array<string>"))
        folds = (F.size(done) > 0) & is_fragment(row) & ~blank(F.try_element_at(last, F.lit(1)))
        return F.when(folds, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(folded(last, row)))).otherwise(F.concat(done, F.array(row)))

    g = F.col(grid)
    df = step_into(df, "_head", header_rows(g))
    df = step_into(df, "_data", F.slice(g, F.col("_head") + 1, F.greatest(F.size(g) - F.col("_head"), F.lit(0))))
    df = step_into(df, "_data", F.aggregate("_data", F.array().cast("array<array<string>>"), step))
    return df.withColumn(grid, F.when(F.size(g) < 3, g).otherwise(F.concat(F.slice(g, F.lit(1), F.col("_head")), F.col("_data")))).drop("_head", "_data")


def column_marks(data: Column, n: Column, least: float = 0.6) -> Column:
    """Right alignment for columns whose cells are mostly numbers."""

    def mark(j: Column) -> Column:
        values = F.filter(F.transform(data, lambda r: strip(at(r, j))), lambda v: v != "")
        numeric = F.size(F.filter(values, is_numeric))
        return F.when((F.size(values) > 0) & (numeric / F.greatest(F.size(values), F.lit(1)) >= least), "---:").otherwise(":---")

    return F.transform(F.sequence(F.lit(0), n - 1), mark)


def row_text(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def render(df: DataFrame, grid: str, out: str) -> DataFrame:
    """``df`` with the Markdown lines of a grid: fragments folded, a two-row header flattened, columns
    without a header left out if every value in them also stands elsewhere in its row."""
    df = merge_fragments(step_into(df, "_g", F.col(grid)), "_g")
    df = step_into(df, "_n", columns(F.col("_g")))
    df = step_into(df, "_g", F.transform("_g", lambda r: wide(F.transform(r, table_cell), F.col("_n"))))
    df = step_into(df, "_head", header_rows(F.col("_g")))
    pairs = F.arrays_zip(F.col("_g")[0].alias("a"), F.coalesce(F.try_element_at("_g", F.lit(2)), F.col("_g")[0]).alias("b"))

    def flat(acc: Column, p: Column) -> Column:
        group = F.when(~blank(p["a"]), p["a"]).otherwise(acc["group"])
        name = F.when(blank(p["b"]), p["a"]).when(group == "", p["b"]).otherwise(strip(F.concat(group, F.lit(" "), p["b"])))
        return F.struct(group.alias("group"), F.concat(acc["names"], F.array(name)).alias("names"))

    start = F.struct(F.lit("").alias("group"), F.array().cast("array<string>").alias("names"))
    df = step_into(df, "_names", F.when(F.col("_head") == 2, F.aggregate(pairs, start, flat)["names"]).otherwise(F.col("_g")[0]))
    df = step_into(df, "_data", F.slice("_g", F.col("_head") + 1, F.greatest(F.size("_g") - F.col("_head"), F.lit(0))))
    # A row's value is needed if it is not blank and stands in that row once.
    lone = lambda r, j: (r[j] != "") & (F.size(F.filter(r, lambda c: c == r[j])) == 1)
    needed = lambda j: (F.col("_names")[j] != "") | F.exists("_data", lambda r: lone(r, j))
    df = step_into(df, "_keep", F.filter(F.sequence(F.lit(0), F.col("_n") - 1), needed))
    df = step_into(df, "_keep", F.when(F.size("_keep") == 0, F.sequence(F.lit(0), F.col("_n") - 1)).otherwise(F.col("_keep")))
    pick = lambda r: F.transform("_keep", lambda j: r[j])
    df = step_into(df, "_data", F.transform("_data", pick))
    lines = F.concat(F.array(row_text(pick(F.col("_names"))), row_text(column_marks(F.col("_data"), F.size("_keep")))), F.transform("_data", row_text))
    return df.withColumn(out, lines).drop("_g", "_n", "_head", "_names", "_data", "_keep")


def grid_cell(c: Column) -> Column:
    return F.replace(collapse(c), F.lit("|"), F.lit("\\|"))
