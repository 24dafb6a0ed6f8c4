"""Row shapes shared by sources, operators and sinks."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


TURN = T.StructType(_strings("from", "value"))
MESSAGE = T.StructType(_strings("role", "content"))
CHAT = T.StructType([T.StructField("conversations", T.ArrayType(TURN))])
MESSAGES = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE))])

# Field names tried in order for each row format.
QUESTION_KEYS = {
    "qa": ("question", "input", "prompt"),
    "instruction": ("query", "problem", "instruction"),
}
ANSWER_KEYS = {
    "qa": ("answer", "output", "response"),
    "instruction": ("answer", "solution", "output"),
}
CODE_KEYS = ("func_code_string", "whole_func_string", "code", "content")
DOC_KEYS = ("func_documentation_string", "docstring", "comment")
JSONL_CODE_KEYS = ("func_code_string", "whole_func_string", "code")
JSONL_DOC_KEYS = ("func_documentation_string", "docstring")

ROW_SCHEMAS = {
    "messages": MESSAGES,
    "qa": T.StructType(_strings(*QUESTION_KEYS["qa"], *ANSWER_KEYS["qa"])),
    "instruction": T.StructType(_strings(*QUESTION_KEYS["instruction"], *ANSWER_KEYS["instruction"])),
    "code": T.StructType(_strings(*CODE_KEYS, *DOC_KEYS)),
}
JSONL_ROW = T.StructType([*CHAT.fields, *_strings(*JSONL_CODE_KEYS, *JSONL_DOC_KEYS)])

UNIT = T.StructType(
    [
        *_strings(
            "kind", "name", "package_name", "module_path", "file_path", "project_name",
            "doc_comment", "code", "signature", "body", "receiver_type",
        ),
        T.StructField("line_number", T.IntegerType()),
        T.StructField("exported", T.BooleanType()),
    ]
)
# Columns of the unit sink: body and line number stay out.
UNIT_SINK_COLUMNS = [f.name for f in UNIT if f.name not in ("body", "line_number")]

SECTION = T.StructType(
    [
        *_strings("title", "content", "domain", "source_name", "file_path"),
        T.StructField("level", T.IntegerType()),
    ]
)
EXAMPLE_COLUMNS = ["example_id", "origin", "example_type", "conversations"]
