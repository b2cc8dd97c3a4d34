"""Chat formatting: a finite-state machine over roles and a declarative
template, as DataFrame expressions only.

``format_chat`` gives one row per conversation:

* ``segments``: array of (text, loss) in output order.  Each turn emits its
  header, its body and its footer; only bodies of roles whose template row
  says so carry the loss flag.
* ``formatted``: the segments' texts joined.
* ``valid``: the role sequence is accepted by the machine (an invalid
  conversation is still formatted, so no row is lost).

Control strings cannot occur inside a body or a role: ``\\`` is doubled and
a ``\\`` is put after the first character of each control string, which
``unescape`` undoes in one pass.  So ``parse_chat`` splits the formatted
text at the footers without ambiguity.

Defined cases: null text or role counts as empty; equal turn numbers are
ordered by role, then text; a repeated row is a turn of its own; a null
conv_id is a conversation; roles outside the template are written as
``### [role]: ``; an empty table gives no rows; other columns are ignored.
One conversation is one output string, so its turns meet in one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """headers: (role, header, loss) rows; moves: (state, role) -> allowed."""

    headers: tuple[tuple[str, str, bool], ...] = (
        ("system", "### System: ", False),
        ("user", "### User: ", False),
        ("assistant", "### Assistant: ", True),
    )
    footer: str = " </turn>\n"
    controls: tuple[str, ...] = ("### ", "</turn>")
    moves: tuple[tuple[str, str], ...] = (
        ("start", "system"), ("start", "user"), ("system", "user"),
        ("user", "assistant"), ("assistant", "user"),
    )
    final: tuple[str, ...] = ("user", "assistant")


DEFAULT = Template()


def escape(c: Column, t: Template = DEFAULT) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for s in t.controls:
        out = F.replace(out, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return out


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _header(role: Column, t: Template) -> Column:
    other = F.concat(F.lit("### ["), F.replace(escape(role, t), F.lit("]"), F.lit("\\]")), F.lit("]: "))
    out = other
    for name, header, _ in t.headers:
        out = F.when(role == name, F.lit(header)).otherwise(out)
    return out


def _accepts(roles: Column, t: Template) -> Column:
    """Run the machine: the state is the last role, '' once it is stuck."""
    arcs = F.create_map(*[F.lit(x) for a, b in t.moves for x in (f"{a}>{b}", b)])
    last = F.aggregate(roles, F.lit("start"),
                       lambda s, r: F.coalesce(F.try_element_at(arcs, F.concat(s, F.lit(">"), r)), F.lit("")))
    return last.isin(*t.final)


def format_chat(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """(conv_id, turn, role, text) rows -> (conv_id, segments, formatted, valid)."""
    t = template
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    learn = role.isin(*[name for name, _, loss in t.headers if loss])
    rows = turns.select("conv_id", F.struct(
        F.col("turn").alias("turn"), role.alias("role"), text.alias("text"),
        _header(role, t).alias("head"), escape(text, t).alias("body"), learn.alias("learn")).alias("_t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_t")).alias("_ts"))

    def seg(text, loss):
        return F.struct(text.alias("text"), loss.alias("loss"))

    segments = F.flatten(F.transform("_ts", lambda x: F.array(
        seg(x["head"], F.lit(False)), seg(x["body"], x["learn"]), seg(F.lit(t.footer), F.lit(False)))))
    return whole.select(
        "conv_id", segments.alias("segments"),
        _accepts(F.transform("_ts", lambda x: x["role"]), t).alias("valid"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse_chat(formatted: Column, template: Template = DEFAULT) -> Column:
    """Read the turns (role, text) back from the formatted text."""
    t = template
    parts = F.split(formatted, "\\Q" + t.footer + "\\E", -1)

    def turn(part):
        mark = r"(?s)^### \[((?:[^\\\]]++|\\.)*+)\]: "
        role = unescape(F.regexp_extract(part, mark, 1))
        text = F.regexp_replace(part, mark, "")
        for name, header, _ in t.headers:
            hit = part.startswith(header)
            role = F.when(hit, F.lit(name)).otherwise(role)
            text = F.when(hit, F.substr(part, F.lit(len(header) + 1))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
