"""Text functions over log contents."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cinderlog import constants as K

def mask(content: Column, masks=K.MASKS) -> Column:
    """Replace variable substrings by the wildcard, one pattern after another."""
    for pattern in masks:
        content = F.regexp_replace(content, pattern, K.WILDCARD)
    return content


def squeeze(text: Column) -> Column:
    """Trim, and make every run of white space one blank."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def hide_digit_tokens(text: Column) -> Column:
    """Replace every token with a digit by the wildcard. The text has single blanks: a
    match then starts at a blank only, and the possessive run keeps it linear."""
    hidden = F.regexp_replace(
        F.concat(F.lit(" "), text), " [^ 0-9]*+[0-9][^ ]*", f" {K.WILDCARD}"
    )
    return F.substr(hidden, F.lit(2))


def first_block_id(content: Column) -> Column:
    return F.regexp_extract(content, K.BLOCK_ID, 1)


def block_ids(content: Column) -> Column:
    """Every distinct block id of a line, in order of first occurrence."""
    return F.array_distinct(F.regexp_extract_all(content, F.lit(K.BLOCK_ID), F.lit(1)))


def endpoint(content: Column, pattern: str) -> Column:
    """The address after "src: " or "dest: " without its leading slash."""
    return F.regexp_replace(F.regexp_extract(content, pattern, 1), "^/", "")


def host(address: Column) -> Column:
    return F.regexp_extract(address, "([^:]+)", 1)


def port(address: Column) -> Column:
    return F.regexp_extract(address, r"([^:]+):(\d+)", 2).try_cast("int")


def first_integer(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("int")


def strip_marks(text: Column) -> Column:
    """Drop quotes, brackets, slashes and a trailing comma around a value."""
    return F.regexp_replace(F.regexp_replace(text, r"[\[\]'/\\]", ""), r",\s*$", "")


def item(values: Column, index: int) -> Column:
    """Array item by position; null past the end."""
    return F.get(values, F.lit(index))


def split_list(text: Column) -> Column:
    """A printed list such as "['a', 'b']" as an array of its cleaned values."""
    return F.transform(F.split(text, ", "), strip_marks)


def named_number(content: Column, name: str) -> Column:
    """The integer after "name: "."""
    return F.regexp_extract(content, rf"\b{name}: (\d+)", 1).try_cast("bigint")
