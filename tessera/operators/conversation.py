"""Conversation repair, as arrays (one row a chat) and exploded (one row a turn)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold_all, tidy
from ..plans.config import Cleaning
from ..sources.shared import once

_TURNS = "array<struct<from:string,value:string>>"


def role_of(role: Column, cfg: Cleaning = Cleaning()) -> Column:
    """human, gpt or null; exact and case-sensitive."""
    return F.when(role.isin(*cfg.user_roles), "human").when(role.isin(*cfg.assistant_roles), "gpt")


def _merged(turns: Column) -> Column:
    """Neighbours of one role joined by a line feed; ``m`` tells that."""
    kind = "array<struct<from:string,value:string,m:boolean>>"

    def add(done: Column, t: Column) -> Column:
        last = F.element_at(done, -1)
        same = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["from"] == t["from"])
        joined = F.struct(t["from"].alias("from"), F.concat_ws("\n", last["value"], t["value"]).alias("value"), F.lit(True).alias("m"))
        fresh = F.struct(t["from"].alias("from"), t["value"].alias("value"), F.lit(False).alias("m"))
        return F.when(same, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(fresh))).cast(kind)

    return F.aggregate(turns, F.array().cast(kind), add)


def repair(df: DataFrame, column: str = "conversations", cfg: Cleaning = Cleaning()) -> DataFrame:
    """With ``messages`` (null if the chat can't be repaired) and ``changed``.

    Unknown roles and empty values go, neighbours of one role are merged, leading
    assistant and trailing user turns go; fewer than two turns left fail. The
    column is an array of (from, value); null (no list at all) and an empty list are
    failures that changed nothing.
    """
    raw = F.coalesce(F.col(column), F.array().cast(_TURNS))
    folded = fold_all(F.transform(raw, lambda m: F.coalesce(m["value"], F.lit(""))))
    turns = F.filter(F.zip_with(raw, "__values", lambda m, v: F.struct(role_of(m["from"], cfg).alias("from"), tidy(v).alias("value"))), lambda m: m["from"].isNotNull() & (m["value"] != ""))
    d = once(once(df.withColumn("__values", folded), {"__turns": turns}), {"__m": _merged(F.col("__turns"))})
    # merged values are normalised again, as joining can make entities and tags
    again = fold_all(F.transform("__m", lambda m: F.when(m["m"], m["value"]).otherwise(F.lit(""))))
    d = once(d.withColumn("__again", again), {"__m": F.zip_with("__m", "__again", lambda m, v: F.struct(m["from"].alias("from"), F.when(m["m"], tidy(v)).otherwise(m["value"]).alias("value")))})
    head = F.when(F.try_element_at("__m", F.lit(1))["from"] == "gpt", 2).otherwise(1)
    tail = F.when(F.try_element_at("__m", F.lit(-1))["from"] == "human", 1).otherwise(0)
    size = F.greatest(F.size("__m") - head + 1 - tail, F.lit(0))
    kept = F.slice(F.col("__m"), head, size)
    return (
        d.withColumn("messages", F.when(size >= 2, kept).cast(_TURNS))
        .withColumn("changed", F.col(column).isNotNull() & (size != F.size(raw)))
        .drop("__values", "__turns", "__m", "__again")
    )


def repair_turns(turns: DataFrame, cfg: Cleaning = Cleaning(), normalize=None) -> DataFrame:
    """(conv_id, turn, role, text): the same over one row a turn, by islands of equal roles; one shuffle on conv_id.

    ``turn`` is renumbered from 0; chats of fewer than two turns left have no rows.
    ``normalize`` is applied to texts before and after merging.
    """
    norm = normalize or (lambda c: c)
    known = turns.select("conv_id", "turn", role_of(F.col("role"), cfg).alias("role"), norm(F.coalesce("text", F.lit(""))).alias("text")).where("role IS NOT NULL AND text <> ''")
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    islands = known.withColumn("n", F.struct("turn", F.row_number().over(by).alias("i"))).withColumn("opens", F.coalesce(F.lag("role").over(by) != F.col("role"), F.lit(True)).cast("int")).withColumn("island", F.sum("opens").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    joined = islands.groupBy("conv_id", "island", "role").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "text"))), lambda s: s["text"]), "\n").alias("text")).withColumn("text", norm(F.col("text")))
    chat = Window.partitionBy("conv_id")
    bounded = joined.withColumn("low", F.min(F.when(F.col("role") == "human", F.col("island"))).over(chat)).withColumn("high", F.max(F.when(F.col("role") == "gpt", F.col("island"))).over(chat)).where("island >= low AND island <= high")
    return bounded.where("high > low").select("conv_id", (F.col("island") - F.col("low")).cast("int").alias("turn"), "role", "text")


def repair_report(turns: DataFrame, cfg: Cleaning = Cleaning()) -> DataFrame:
    """(chats, repaired, failed) of one-row-a-turn chats."""
    raw = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_raw"))
    done = repair_turns(turns, cfg).groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    both = raw.join(done, "conv_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return both.agg(F.count(F.lit(1)).alias("chats"), F.count_if(F.expr("n <> n_raw")).alias("repaired"), F.count_if(F.expr("n = 0")).alias("failed"))


def system_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, system_prompt): the last system turn of each chat, kept as metadata."""
    return turns.where("role = 'system'").groupBy("conv_id").agg(F.max_by("text", "turn").alias("system_prompt"))


_USER = ("human", "user", "observation")
_ASSISTANT = ("gpt", "assistant", "function_call")


def format_tool_call(value: Column) -> Column:
    """A function_call value as action lines, if it names a function and its arguments."""
    name, args = F.get_json_object(value, "$.name"), F.get_json_object(value, "$.arguments")
    return F.when(name.isNotNull() & args.isNotNull(), F.concat(F.lit("Action: "), name, F.lit("\nAction Input: "), args)).otherwise(value)


def format_observation(value: Column, tool_format: str = "default") -> Column:
    before, after = {"qwen": ("<tool_response>\n", "\n</tool_response>"), "glm4": ("<|observation|>\n", ""), "mistral": ('[TOOL_RESULTS] {"content": ', "}[/TOOL_RESULTS]")}.get(tool_format, ("Observation: ", ""))
    return F.concat(F.lit(before), value, F.lit(after))


def history(conversations: Column, trailing_user: bool = False, tools: str | None = None) -> Column:
    """[(user, assistant)] pairs of a chat.

    Consecutive user turns are joined by a line feed; an assistant turn that follows
    no open user turn is skipped. With ``trailing_user`` a last user turn gets an
    empty reply, and tool turns are formatted for ``tools``.
    """
    kind = "struct<done:array<struct<user:string,assistant:string>>,open:string>"

    def step(s: Column, m: Column) -> Column:
        value = F.coalesce(m["value"], F.lit(""))
        if tools is not None:
            value = F.when(m["from"] == "observation", format_observation(value, tools)).when(m["from"] == "function_call", format_tool_call(value)).otherwise(value)
        user, reply = m["from"].isin(*_USER), m["from"].isin(*_ASSISTANT)
        asked = F.struct(s["done"].alias("done"), F.concat_ws("\n", s["open"], value).alias("open"))
        answered = F.struct(F.concat(s["done"], F.array(F.struct(s["open"].alias("user"), value.alias("assistant")))).alias("done"), F.lit(None).cast("string").alias("open"))
        return F.when(user, asked.cast(kind)).when(reply & s["open"].isNotNull(), answered.cast(kind)).otherwise(s)

    start = F.struct(F.array().cast("array<struct<user:string,assistant:string>>").alias("done"), F.lit(None).cast("string").alias("open")).cast(kind)

    def finish(s: Column) -> Column:
        if not trailing_user:
            return s["done"]
        return F.when(s["open"].isNotNull(), F.concat(s["done"], F.array(F.struct(s["open"].alias("user"), F.lit("").alias("assistant"))))).otherwise(s["done"])

    return F.aggregate(conversations, start, step, finish)


def system_prompt(conversations: Column, default: Column | None = None, tools_text: Column | None = None) -> Column:
    """The last system value, else the default; tool text follows after a blank line."""
    last = F.element_at(F.concat(F.array(F.lit("")), F.transform(F.filter(conversations, lambda m: m["from"] == "system"), lambda m: F.coalesce(m["value"], F.lit("")))), -1)
    if tools_text is not None:
        last = F.concat_ws("\n\n", F.nullif(last, F.lit("")), F.nullif(tools_text, F.lit("")))
    return last if default is None else F.when(last == "", F.coalesce(default, F.lit(""))).otherwise(last)


def pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, question, answer): each user turn that an assistant turn follows at once."""
    by = Window.partitionBy("conv_id").orderBy("turn")
    nxt = turns.select("conv_id", "turn", "role", F.col("text").alias("question"), F.lead("role").over(by).alias("__r"), F.lead("text").over(by).alias("answer"))
    return nxt.where("role = 'user' AND __r = 'assistant'").select("conv_id", "turn", "question", "answer")


def rl_prompts(conversations: DataFrame, column: str = "conversations") -> DataFrame:
    """One row (all columns, ``turn``, ``prompt``) for each user turn of chats that alternate strictly, end with a reply and, after a leading turn of another role is dropped, begin with a user."""
    c = F.col(column)
    human = F.array_position(F.transform(c, lambda m: m["from"].isin(*_USER)), True).cast("int")
    chat = F.slice(c, F.greatest(human, F.lit(1)), F.size(c))
    alternates = F.forall(F.transform("__c", lambda m, i: F.when(i % 2 == 0, m["from"].isin(*_USER)).otherwise(m["from"].isin(*_ASSISTANT))), lambda x: x)
    good = conversations.withColumn("__c", F.when(human > 0, chat)).where((F.size("__c") > 0) & (F.size("__c") % 2 == 0)).where(alternates)
    users = F.filter(F.col("__c"), lambda m, i: i % 2 == 0)
    return good.select(*conversations.columns, F.posexplode(F.transform(users, lambda m: m["value"])).alias("turn", "prompt"))


def first_pair(conversations: Column) -> Column:
    """(user, assistant) of the first two turns; null for a shorter chat."""
    return F.when(F.size(conversations) >= 2, F.struct(conversations[0]["value"].alias("user"), conversations[1]["value"].alias("assistant")))
