"""Chat examples from code units and sections.

Generators are column builders: when they apply, the question, the answer. One scan of the
units explodes the names of those that apply; texts are made above that, so a count makes
none of them and a filter on the type makes only its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.config import (
    MAX_PAIR_CODE_CHARS,
    MAX_PAIR_DOC_CHARS,
    MIN_BODY_CHARS,
    MIN_PAIR_BODY_CHARS,
    MIN_PAIR_CODE_CHARS,
    MIN_PAIR_DOC_CHARS,
    CorpusConfig,
    Wording,
)
from corpusflow.functions import chat
from corpusflow.functions import text as tx
from corpusflow.functions.hashing import keep_share, pick
from corpusflow.operators.filters import size_between


def fill(template: str, **values: Column) -> Column:
    """Replace the {names} of a fixed template by columns, as one concat."""
    parts: list[Column] = []
    rest = template
    while rest:
        text, brace, tail = rest.partition("{")
        if text:
            parts.append(F.lit(text))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        parts.append(values[name])
    return F.concat(*parts)


def fenced(code: Column, language: str) -> Column:
    return F.concat(F.lit(f"```{language}\n"), code, F.lit("\n```"))


def paragraphs(*parts: Column) -> Column:
    """Non-null parts with one blank line between them."""
    return F.concat_ws("\n\n", *parts)


def unit_id() -> Column:
    return F.concat_ws("|", "project_name", "file_path", F.col("line_number").cast("string"))


def explanation(w: Wording) -> tuple[Column, Column, Column]:
    """Documented function or method: its code with doc, answered by doc, place, signature."""
    entity = F.when(
        F.col("kind") == "method", fill(w.method, name=F.col("name"), receiver=F.col("receiver_type"))
    ).otherwise(fill(w.function, name=F.col("name")))
    question = fill(
        w.explain, entity=entity, module=F.col("module_path"), project=F.col("project_name")
    )
    answer = paragraphs(
        F.col("doc_comment"),
        fill(w.located, file=F.col("file_path"), package=F.col("package_name")),
        fill(w.signature, signature=F.col("signature")),
    )
    applies = F.col("kind").isin("func", "method") & (F.col("doc_comment") != "")
    return applies, paragraphs(question, fenced(F.col("code"), w.fence)), answer


def completion(w: Wording) -> tuple[Column, Column, Column]:
    """Function or method with a real body: doc and signature, answered by the body."""
    doc = F.when(F.col("doc_comment") != "", tx.comment_lines(F.col("doc_comment")))
    opening = F.concat_ws("\n", doc, F.concat(F.col("signature"), F.lit(" {")))
    applies = F.col("kind").isin("func", "method") & (F.length("body") >= MIN_BODY_CHARS)
    return applies, paragraphs(F.lit(w.complete), fenced(opening, w.fence)), fenced(F.col("body"), w.fence)


def member_count(body: Column) -> Column:
    """Lines of a type body that are neither blank nor comments."""
    shown = F.transform(F.split(body, "\n", -1), tx.strip)
    return F.size(F.filter(shown, lambda s: (s != "") & ~F.startswith(s, F.lit("//"))))


def type_documentation(w: Wording) -> tuple[Column, Column, Column]:
    """Documented type: its code with doc, answered by doc, place and member count."""
    count = member_count(F.col("body"))
    label = F.when(F.col("kind") == "type_struct", F.lit(w.fields_label)).otherwise(
        F.lit(w.methods_label)
    )
    question = fill(
        w.describe_type,
        name=F.col("name"), module=F.col("module_path"), project=F.col("project_name"),
    )
    answer = paragraphs(
        F.col("doc_comment"),
        fill(w.located, file=F.col("file_path"), package=F.col("package_name")),
        F.when(count > 0, fill(w.members, count=count.cast("string"), label=label)),
    )
    applies = F.startswith("kind", F.lit("type_")) & (F.col("doc_comment") != "")
    return applies, paragraphs(question, fenced(F.col("code"), w.fence)), answer


def _makers(config: CorpusConfig, only: tuple[str, ...] | None) -> dict[str, tuple[Column, tuple[Column, Column, Column]]]:
    """Per example type: whether its weight keeps a unit; when it applies, question and answer."""
    w = config.wording

    def kept(example_type: str, sampled: bool) -> Column:
        weight = config.weight(example_type)
        if sampled or config.sample_all:
            return keep_share(unit_id(), config.seed, example_type, weight)
        return F.lit(weight > 0)

    makers = {
        "code_explanation": (kept("code_explanation", False), explanation(w)),
        "code_completion": (kept("code_completion", True), completion(w)),
        "type_documentation": (kept("type_documentation", True), type_documentation(w)),
    }
    return {name: maker for name, maker in makers.items() if only is None or name in only}


def unit_examples(units: DataFrame, config: CorpusConfig, only: tuple[str, ...] | None = None) -> DataFrame:
    """Examples of single units: size filter, weights, then the generators' own filters. `only`
    names the types to make; by default all."""
    makers = _makers(config, only)
    named = F.array(*[F.when(keep & applies, F.lit(name)) for name, (keep, (applies, _, _)) in makers.items()])
    sized = units.filter(size_between(F.col("code"), config.min_code_chars, config.max_code_chars))
    rows = sized.select("*", F.explode(F.array_compact(named)).alias("example_type"))
    question = answer = F.lit(None)
    for name, (_, (_, asked, told)) in makers.items():
        question = F.when(F.col("example_type") == name, asked).otherwise(question)
        answer = F.when(F.col("example_type") == name, told).otherwise(answer)
    return rows.select(
        F.concat_ws("|", F.lit("code"), unit_id(), "example_type").alias("example_id"),
        F.lit("code").alias("origin"),
        "example_type",
        chat.triple(config.system_prompt, question, answer).alias("conversations"),
    )


#: What counts of examples need of a unit; of its long texts only the lengths decide.
COUNTED = ("project_name", "module_path", "package_name", "file_path", "line_number", "kind", "name", "exported", "doc_comment")


def counted_units(units: DataFrame) -> DataFrame:
    return units.select(*COUNTED, F.length("code").alias("code_chars"), F.length("body").alias("body_chars"))


def unit_example_types(counted: DataFrame, config: CorpusConfig) -> DataFrame:
    """(origin, example_type) of the examples that `unit_examples` makes, from `counted_units`."""
    documented, code = F.col("doc_comment") != "", F.col("kind").isin("func", "method")
    applies = {
        "code_explanation": code & documented,
        "code_completion": code & (F.col("body_chars") >= MIN_BODY_CHARS),
        "type_documentation": F.startswith("kind", F.lit("type_")) & documented,
    }
    named = F.array(*[F.when(keep & applies[name], F.lit(name)) for name, (keep, _) in _makers(config, None).items()])
    sized = counted.filter(F.col("code_chars").between(config.min_code_chars, config.max_code_chars))
    return sized.select(F.lit("code").alias("origin"), F.explode(F.array_compact(named)).alias("example_type"))


def section_examples(sections: DataFrame, config: CorpusConfig) -> DataFrame:
    """One example per kept section: a question in one of the wordings, the text as answer."""
    sid = F.concat_ws(
        "|", "source_name", "file_path", F.col("position").cast("string")
    )
    keep = keep_share(sid, config.seed, "spec_explanation", config.weight("spec_explanation"))
    template = pick(sid, config.seed, "wording", list(config.wording.sections))
    question = F.replace(
        F.replace(template, F.lit("{domain}"), F.col("domain")), F.lit("{title}"), F.col("title")
    )
    return sections.filter(keep).select(
        F.concat_ws("|", F.lit("section"), sid).alias("example_id"),
        F.lit("section").alias("origin"),
        F.lit("spec_explanation").alias("example_type"),
        chat.triple(config.system_prompt, question, F.col("content")).alias("conversations"),
    )


def code_pairs(df: DataFrame, code: Column, doc: Column, prompt: str, w: Wording) -> DataFrame:
    """Add `conversations` made from code and doc columns, null if a row makes no example.

    Long doc: explain the code. Otherwise: complete the text between the outer braces.
    The steps are separate selects, so each text is cut once.
    """
    others = df.columns
    cut = df.select(
        "*",
        (F.length(code) >= MIN_PAIR_CODE_CHARS).alias("__long"),
        F.substring(code, 1, MAX_PAIR_CODE_CHARS).alias("__code"),
        F.when(
            F.length(doc) > MIN_PAIR_DOC_CHARS, tx.strip(F.substring(doc, 1, MAX_PAIR_DOC_CHARS))
        ).alias("__doc"),
    )
    parts = cut.select(
        "*",
        tx.strip(tx.before_first(F.col("__code"), "{")).alias("__signature"),
        tx.strip(tx.between_first_and_last(F.col("__code"), "{", "}")).alias("__body"),
    )
    explains = F.col("__doc").isNotNull()
    asked = F.when(
        explains, paragraphs(F.lit(w.pair_explain), fenced(F.col("__code"), w.fence))
    ).otherwise(
        paragraphs(
            F.lit(w.pair_complete), fenced(F.concat("__signature", F.lit(" {")), w.fence)
        )
    )
    answered = F.when(explains, F.col("__doc")).otherwise(fenced(F.col("__body"), w.fence))
    made = F.col("__long") & (explains | (F.length("__body") >= MIN_PAIR_BODY_CHARS))
    return parts.select(
        *others, F.when(made, chat.triple(prompt, asked, answered)).alias("conversations")
    )
