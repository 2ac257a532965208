"""The ordered passes that turn joined chunks into a clean document, on exploded lines from end to end."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..config import Config
from ..operators import passes as P
from ..operators.lines import assemble, explode_lines


@dataclass(frozen=True)
class Inputs:
    """What the passes read beside the text; passes without their input are left out."""

    footers: DataFrame | None = None
    bold_labels: DataFrame | None = None
    leak_labels: tuple[str, ...] = ()
    leak_phrases: tuple[str, ...] = ()
    leak_signatures: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict)


def clean_lines(lines: DataFrame, config: Config = Config(), inputs: Inputs = Inputs()) -> DataFrame:
    lines = P.renumber_figures(lines)
    if inputs.leak_labels or inputs.leak_phrases or inputs.leak_signatures:
        lines = P.drop_phrases(lines, inputs.leak_labels, inputs.leak_phrases, inputs.leak_signatures)
    lines = P.drop_runaway(lines)
    lines = P.merge_straddles(lines)
    lines = P.dedup_captions(lines)
    lines = P.style_lines(lines)
    if inputs.footers is not None:
        lines = P.strip_footer_numbers(lines, inputs.footers)
    if inputs.bold_labels is not None:
        lines = P.promote_bold(lines, inputs.bold_labels)
    lines = P.dedup_headings(lines)
    lines = P.normalise_bullets(lines)
    lines = P.balance_fences(lines)
    return P.flag_html_tables(lines, config.marker)


def clean(docs: DataFrame, config: Config = Config(), inputs: Inputs = Inputs()) -> DataFrame:
    """docs (doc_id, md) → doc_id, md; a null text stays null."""
    out = assemble(clean_lines(explode_lines(docs), config, inputs))
    return docs.select("doc_id").join(out, "doc_id", "left")
