"""Pseudonymisation and the vault split.

Clear identifiers are replaced by keyed tokens; the clear values and their
tokens go to a separate "vault" table in a restricted location, and the
public table keeps only the tokens. Because tokens are deterministic, the
vault joins back to the public table on the token.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffmart.functions.tokens import TokenKey, as_key, hide_key, key_id_of, token
from staffmart.sources.sinks import merge_partitions, stamp


def pseudonymize(df: DataFrame, mapping: Mapping[str, str], key: TokenKey | str,
                 fields: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``mapping[src]`` = token(src) for every ``src`` column.

    A token depends on its field, which is the column's name unless ``fields``
    gives another: name the same field wherever the same identifier occurs.
    """
    hide_key(df.sparkSession, key)
    fields = fields or {}
    return df.withColumns({dst: token(src, key, fields.get(src, src)) for src, dst in mapping.items()})


def split_vault(df: DataFrame, vault_columns: Sequence[str],
                clear_columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(vault, public): the vault keeps clear values with their tokens, the
    public table drops the clear columns."""
    vault = df.select(*vault_columns)
    public = df.drop(*clear_columns)
    return vault, public


def reidentify(public: DataFrame, vault: DataFrame, token_column: str,
               clear_columns: Sequence[str]) -> DataFrame:
    """Join clear values back for an authorised reader.

    Every public row stays; without an entry in the vault its clear values are
    NULL. Of several entries for a token the smallest counts, in every run.
    """
    one = vault.groupBy(token_column).agg(F.min(F.struct(*clear_columns)).alias("clear"))
    clear = one.select(token_column, *[F.col(f"clear.{c}").alias(c) for c in clear_columns])
    return public.join(clear, on=token_column, how="left")


# ------------------------------------------------------------- keeping a vault

# Vaults are partitioned by the first digits of a token, so that a merge or an
# erasure rewrites only the parts that hold the people concerned.
BUCKET, BUCKET_DIGITS = "bucket", 2


def with_bucket(vault: DataFrame, token_column: str) -> DataFrame:
    """Add the partition of each row: the first digits behind the key id."""
    digits = F.substring(F.substring_index(token_column, ".", -1), 1, BUCKET_DIGITS)
    # a letter in front, so that no reader takes the bucket for a number
    return vault.withColumn(BUCKET, F.concat(F.lit("b"), F.coalesce(digits, F.lit("0" * BUCKET_DIGITS))))


def merge_vault(people: DataFrame, path: str, token_column: str, run_ts: str | None = None) -> int:
    """Upsert people into a kept vault: one row per token, the newest drop wins.

    Within a drop the smallest row of a token counts, in every run. Returns the
    number of parts rewritten.
    """
    rest = [c for c in people.columns if c != token_column]
    one = (people.groupBy(token_column).agg(F.min(F.struct(*rest)).alias("row"))
           .select(token_column, *[F.col(f"row.{c}").alias(c) for c in rest]))
    return merge_partitions(people.sparkSession, path, with_bucket(stamp(one, run_ts), token_column),
                            [token_column], [BUCKET])


def erase(tokens: DataFrame, path: str, token_column: str) -> int:
    """Delete the people of these tokens from a kept vault; their public rows can't be read back any more."""
    gone = with_bucket(tokens.select(token_column).distinct(), token_column)
    return merge_partitions(tokens.sparkSession, path, gone, [token_column], [BUCKET], remove_keys=True)


# ------------------------------------------------------------------ rotation


def rotate(vault: DataFrame, mapping: Mapping[str, str], key: TokenKey | str,
           fields: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(vault with tokens of the new key, crosswalk (field, old_token, new_token)).

    ``mapping`` names the clear columns and their token columns. Only the vault
    can make new tokens, for it alone holds the clear values.
    """
    fields = fields or {}
    old = {dst: f"__old_{dst}" for dst in mapping.values()}
    renamed = vault.withColumnsRenamed(old)
    both = pseudonymize(renamed, mapping, key, fields)
    pairs = F.array(*[F.struct(F.lit(fields.get(src, src)).alias("field"), F.col(old[dst]).alias("old_token"),
                               F.col(dst).alias("new_token")) for src, dst in mapping.items()])
    crosswalk = both.select(F.inline(pairs)).filter("old_token IS NOT NULL").distinct()
    return both.drop(*old.values()).select(*vault.columns), crosswalk


def apply_rotation(public: DataFrame, crosswalk: DataFrame, mapping: Mapping[str, str], key: TokenKey | str,
                   fields: Mapping[str, str] | None = None) -> DataFrame:
    """Replace tokens of older keys by those of ``key``; other rows stay, tokens without an entry become NULL.

    Tables can be re-keyed one after the other: a row that has the new key's
    tokens already is left alone, so a second run changes nothing.
    """
    fields, out = fields or {}, public
    for src, dst in mapping.items():
        own = crosswalk.filter(F.col("field") == fields.get(src, src)).select(
            F.col("old_token").alias(dst), F.col("new_token").alias("__new"))
        current = key_id_of(dst) == F.lit(as_key(key).key_id)
        out = out.join(own, dst, "left").withColumn(
            dst, F.when(current, F.col(dst)).otherwise(F.col("__new"))).drop("__new")
    return out.select(*public.columns)
