"""Keys, names, tokens and instructions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.operators.datasets import encode

DEFAULT_INSTRUCTION = "Follow the main person."
SPECIAL = ["<pad>", "<s>", "</s>", "<unk>"]


def ref(episode: Column, frame: Column, camera: Column) -> Column:
    return F.concat(episode, F.lit("/"), F.lpad(frame.cast("string"), 6, "0"), F.lit("/"), camera)


def parse_ref(text: Column) -> list[Column]:
    """Episode, frame and camera; the episode may hold slashes."""
    pattern = "^(.*)/([^/]+)/([^/]+)$"
    part = lambda i: F.regexp_extract(text, pattern, i)
    return [part(1).alias("episode_id"), part(2).cast("long").alias("frame_index"), part(3).alias("camera")]


def context_key(dataset: str, split: str, episode: Column, frame: Column, policy: str) -> Column:
    return F.concat(F.lit(f"{dataset}/{split}/"), episode, F.lit("/f"), F.lpad(frame.cast("string"), 6, "0"), F.lit(f"/{policy}"))


def scene_name(path: Column, first_dot: bool = False) -> Column:
    """File name without its last extension, or without all of them."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\..*$" if first_dot else r"\.[^.]*$", "")


def natural_key(text: Column) -> list[Column]:
    """Sort columns: digit strings first, by number."""
    digits = text.rlike("^[0-9]+$")
    return [(~digits).cast("int"), F.when(digits, text.try_cast("decimal(38,0)")), text]


def natural_split_key(text: Column) -> Column:
    """A sort key that compares runs of digits as numbers, letters in lower case."""
    runs = F.regexp_extract_all(F.lower(text), F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike("^[0-9]+$"), F.lpad(r, 20, "0")).otherwise(r)), "")


def tokens(text: Column, drop: tuple[str, ...] = (",", "?")) -> Column:
    """Lower-case words and the runs between them that are not blank; ``drop`` is removed first."""
    low = F.lower(text)
    for mark in drop:
        low = F.replace(low, F.lit(mark), F.lit(""))
    parts = F.regexp_extract_all(low, F.lit(r"((?U)[\w-]+|[^\w-]+)"), F.lit(1))
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", "")), lambda p: p != "")


def vocabulary(df: DataFrame, words: str, position: str, least: int = 1, only_unknown: bool = False) -> DataFrame:
    """(word, id): the special words, then words of at least ``least`` uses in the order of their first."""
    special = ["<unk>"] if only_unknown else SPECIAL
    each = df.select(F.col(position).alias("p"), F.posexplode(words).alias("i", "word"))
    kept = each.groupBy("word").agg(F.count("*").alias("n"), F.min(F.struct("p", "i")).alias("first")).where(F.col("n") >= least)
    ids = encode(kept.where(~F.col("word").isin(*special)), "word", "first")
    extra = df.sparkSession.createDataFrame(list(enumerate(special)), "id long, word string")
    return ids.select("word", (F.col("id") + len(special)).alias("id")).unionByName(extra)


def word_ids(df: DataFrame, words: str, key: str, vocab: DataFrame) -> DataFrame:
    """One row per word with its id, that of the unknown word if it has none."""
    each = df.select(key, F.posexplode(words).alias("i", "word"))
    unknown = vocab.where("word = '<unk>'").select(F.col("id").alias("unk"))
    return each.join(vocab, "word", "left").crossJoin(F.broadcast(unknown)).select(key, "i", "word", F.coalesce("id", "unk").alias("id"))  # unknown is one row


def instruction(given: Column, stored: Column, default: str = DEFAULT_INSTRUCTION) -> Column:
    """The first that is not blank, trimmed."""
    full = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(full(given), full(stored), F.lit(default))


def instruction_or_blank(stored: Column, default: str = DEFAULT_INSTRUCTION) -> Column:
    """The default replaces null or empty only; blanks are trimmed to the empty string after that."""
    return F.trim(F.coalesce(F.nullif(stored, F.lit("")), F.lit(default)))


def call_parts(text: Column) -> list[Column]:
    """name(arg, arg) → its name and arguments."""
    inner = F.regexp_extract(text, r"^\s*([^(]+)\(([^)]*)\)\s*$", 2)
    args = F.filter(F.transform(F.split(inner, ","), lambda a: F.trim(a)), lambda a: a != "")
    return [F.trim(F.regexp_extract(text, r"^\s*([^(]+)\(([^)]*)\)\s*$", 1)).alias("name"), args.alias("args")]


def truthy(text: Column) -> Column:
    """A value read from JSON text as a dynamic language sees it: zero, empty, null and false are not true, any other string is."""
    number = text.try_cast("double")
    falsy = text.isNull() | text.isin("", "null", "false", '""', "[]", "{}")
    return F.when(falsy, False).when(number.isNotNull(), number != 0).otherwise(True)


def first_number(values: Column, default: float = 0.0) -> Column:
    """First element as a number; missing, empty and not-a-number give the default."""
    x = F.get(values, 0).cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit(default)).otherwise(x)


def sentence(ids: Column, words: Column) -> Column:
    """The words of ``ids`` in the array ``words``, each with a space after it and a question mark at the end; id 0 is padding."""
    real = F.filter(ids, lambda i: i != 0)
    return F.concat(F.array_join(F.transform(real, lambda i: F.concat(F.get(words, i.cast("int")), F.lit(" "))), ""), F.lit("?"))


def stamp(time: Column) -> Column:
    """A moment as backups are named by it."""
    return F.date_format(F.to_utc_timestamp(time, F.current_timezone()), "yyyyMMdd'T'HHmmss'Z'")


def parse_stamp(text: Column) -> Column:
    return F.from_utc_timestamp(F.to_timestamp(text, "yyyyMMdd'T'HHmmss'Z'"), F.current_timezone())


def iso_time(time: Column) -> Column:
    """A moment as logs tell it, in UTC."""
    return F.date_format(F.to_utc_timestamp(time, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def flat_fields(df: DataFrame, separator: str = ".") -> list[Column]:
    """All leaves of ``df``'s nested structs as columns named by their paths."""
    from pyspark.sql.types import StructType

    def leaves(fields: StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in fields:
            here = (*path, f.name)
            quoted = ".".join(f"`{x}`" for x in here)
            out += leaves(f.dataType, here) if isinstance(f.dataType, StructType) else [F.col(quoted).alias(separator.join(here))]
        return out

    return leaves(df.schema, ())
