"""A frequency vocabulary with byte fallback, and encode/decode as narrow column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.pretokens import WORDS, pretokens
from millrace.session import written

# Special tokens in id order.
PLAIN_SPECIALS = ("<|endoftext|>", "<|im_start|>", "<|im_end|>")
PAD, START, END = PLAIN_SPECIALS
# Added tokens that decoding keeps.
KEPT_TOKENS = (
    "<think>", "</think>", "<tool_call>", "</tool_call>", "<tool_response>", "</tool_response>",
)
VOCAB_SIZE = 6400
_BYTES = 256
_BUCKETS = 4096
MAX_VOCAB = 200_000
MAX_ADDED = 2_000


def build_vocab(
    texts: DataFrame,
    column: str = "text",
    size: int = VOCAB_SIZE,
    specials: tuple[str, ...] = PLAIN_SPECIALS,
    kept: tuple[str, ...] = (),
    pieces: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """(token, token_id, special): specials, kept markers, 256 bytes, then the most frequent
    pre-tokens up to ``size`` ids, ties in token order. At most ``size`` rows. ``pieces`` cuts
    the texts in place of the fixed markers."""
    spark = texts.sparkSession
    added = [*specials, *kept]
    words_from = len(added) + _BYTES
    fixed = spark.range(words_from).select(
        F.when(
            F.col("id") < len(added),
            F.get(F.array(*[F.lit(t) for t in added]), F.col("id").cast("int")),
        )
        .otherwise(
            F.concat(
                F.lit("<0x"), F.lpad(F.hex(F.col("id") - len(added)), 2, "0"), F.lit(">")
            )
        )
        .alias("token"),
        F.col("id").cast("int").alias("token_id"),
        (F.col("id") < len(specials)).alias("special"),
    )
    cut = pretokens if pieces is None else pieces
    counts = (
        texts.select(F.explode(cut(F.col(column))).alias("token"))
        .where(~F.col("token").isin(added))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    top = counts.orderBy(F.desc("n"), "token").limit(size - words_from)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "token")))
    words = top.agg(F.transform(ordered, lambda w: w["token"]).alias("words")).select(
        F.posexplode("words").alias("_rank", "token")
    )
    return fixed.unionByName(
        words.select(
            "token",
            (F.col("_rank") + words_from).cast("int").alias("token_id"),
            F.lit(False).alias("special"),
        )
    )


@dataclass(frozen=True)
class AddedTokens:
    """Added tokens as a table gives them: each is one pre-token wherever it may stand.

    ``rules`` are (content, special, lstrip, rstrip, single_word) in id order. Of two tokens that
    start at one place the longer one counts. A token with ``lstrip`` or ``rstrip`` takes the
    white space on that side with it; one of ``single_word`` stands only between characters
    that are no letters, digits or underscores.
    """

    rules: tuple[tuple[str, bool, bool, bool, bool], ...]

    @classmethod
    def of(cls, table: DataFrame) -> AddedTokens:
        """From ``token_id, content, special, lstrip, rstrip, single_word``, ids from 0 on."""
        rows = table.orderBy("token_id").limit(MAX_ADDED + 1).collect()
        if len(rows) > MAX_ADDED or [row["token_id"] for row in rows] != list(range(len(rows))):
            raise ValueError(f"added tokens need the ids from 0 on, {MAX_ADDED} at most")
        names = ("content", "special", "lstrip", "rstrip", "single_word")
        rules = tuple(tuple(row[name] for name in names) for row in rows)
        # Ids stand in the vocabulary as specials first, then the others.
        if [rule[1] for rule in rules] != sorted((rule[1] for rule in rules), reverse=True):
            raise ValueError("special tokens come before other added tokens")
        return cls(rules)

    @property
    def specials(self) -> tuple[str, ...]:
        return tuple(content for content, special, *_ in self.rules if special)

    @property
    def kept(self) -> tuple[str, ...]:
        return tuple(content for content, special, *_ in self.rules if not special)

    @cached_property
    def pattern(self) -> str:
        """Tokens, the longest first, then the words of :data:`WORDS` up to the next token."""
        if not self.rules:
            return WORDS
        forms = []
        for content, _, left, right, word in sorted(self.rules, key=lambda rule: -len(rule[0])):
            form = re.sub(r"([^\w\s])", r"\\\1", content)
            form = rf"(?<!\w){form}(?!\w)" if word else form
            forms.append(("\\s*" if left else "") + form + ("\\s*" if right else ""))
        # A word ends where a token begins.
        ahead = "|".join(forms)
        words = rf" ?(?:(?!{ahead})[^ \t\r\n])+|\n|(?:(?!{ahead})[ \t\r])+"
        return f"{ahead}|{words}"

    def pretokens(self, text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))
        stripped = [content for content, _, left, right, _ in self.rules if left or right]
        if not stripped:
            return found

        def bare(token: Column) -> Column:
            inner = F.regexp_replace(token, r"^\s+|\s+$", "")
            return F.when(inner.isin(stripped), inner).otherwise(token)

        return F.transform(found, bare)

    def tokenizer(self, texts: DataFrame, column: str = "text", size: int = VOCAB_SIZE) -> Tokenizer:
        """A tokenizer of these tokens, the bytes and the most frequent words of ``texts``."""
        vocab = build_vocab(texts, column, size, self.specials, self.kept, self.pretokens)
        return Tokenizer(vocab, self)


class Tokenizer:
    """Encode and decode against a vocabulary table whose ids run from zero.

    The vocabulary reaches the tasks as two constants: an array of small hash buckets for
    lookups by token and an array of bytes for lookups by id. Neither direction explodes
    text into token rows, so neither needs an exchange. The constants are built by Spark and
    their size is checked before they pass through the driver.
    """

    def __init__(self, vocab: DataFrame, added: AddedTokens | None = None) -> None:
        # Written once, so that no later query counts the corpus again.
        self.vocab = written(vocab.coalesce(1))
        self.added = added
        first_byte = self.vocab.where(F.col("token") == "<0x00>").agg(F.min("token_id")).first()[0]
        if first_byte is None:
            raise ValueError("a vocabulary needs its 256 bytes from <0x00> on")
        self.byte_base = first_byte
        size = self.vocab.count()
        if size > MAX_VOCAB:
            raise ValueError(f"vocabulary of {size} tokens, at most {MAX_VOCAB} fit")
        self._pieces: dict[bool, Column] = {}
        self._constants: dict[str, list[int]] = {}

    @cached_property
    def _buckets(self) -> Column:
        bucket = F.pmod(F.xxhash64("token"), F.lit(_BUCKETS))
        # Byte tokens are reached through the fallback, never by their names.
        is_byte = (F.col("token_id") >= self.byte_base) & (
            F.col("token_id") < self.byte_base + _BYTES
        )
        entry = F.struct(F.col("token").alias("key"), F.array("token_id").alias("value"))
        filled = (
            self.vocab.where(~is_byte)
            .groupBy(bucket.alias("id"))
            .agg(F.collect_list(entry).alias("entries"))
        )
        every = self.vocab.sparkSession.range(_BUCKETS).join(F.broadcast(filled), "id", "left")
        ordered = F.array_sort(F.collect_list(F.struct("id", "entries")))
        maps = F.transform(ordered, lambda b: F.map_from_entries(b["entries"]))
        text = every.agg(F.to_json(maps, {"ignoreNullFields": "false"})).first()[0]
        return F.from_json(F.lit(text), "array<map<string,array<int>>>")

    def _piece_of(self, skip_special: bool) -> Column:
        if skip_special not in self._pieces:
            at = F.col("token_id") - self.byte_base
            piece = (
                F.when(F.col("special") & F.lit(skip_special), F.lit(""))
                .when(at.between(0, _BYTES - 1), F.lpad(F.hex(at.cast("bigint")), 2, "0"))
                .otherwise(F.hex(F.encode("token", "UTF-8")))
            )
            ordered = F.array_sort(F.collect_list(F.struct("token_id", piece.alias("piece"))))
            texts = F.transform(ordered, lambda p: p["piece"])
            text = self.vocab.agg(F.to_json(texts)).first()[0]
            self._pieces[skip_special] = F.from_json(F.lit(text), "array<string>")
        return self._pieces[skip_special]

    def _bytes_of(self, token: Column) -> Column:
        """Ids of the UTF-8 bytes: read as Latin-1, every byte is one character."""
        as_chars = F.decode(F.encode(token, "UTF-8"), "ISO-8859-1")
        return F.transform(F.split(as_chars, ""), lambda c: F.ascii(c) + self.byte_base)

    def encode(self, text: Column, limit: int | None = None) -> Column:
        """Token ids; ``limit`` keeps the first ids and looks no further pre-token up."""
        tokens = pretokens(text) if self.added is None else self.added.pretokens(text)
        if limit is not None:
            # Every pre-token yields at least one id.
            tokens = F.slice(tokens, 1, limit)

        def ids_of_token(token: Column) -> Column:
            bucket = F.pmod(F.xxhash64(token), F.lit(_BUCKETS)).cast("int")
            known = F.element_at(F.get(self._buckets, bucket), token)
            return F.coalesce(known, self._bytes_of(token))

        ids = F.flatten(F.transform(tokens, ids_of_token))
        return ids if limit is None else F.slice(ids, 1, limit)

    def decode(self, ids: Column, skip_special: bool = True) -> Column:
        """Text of the ids; malformed byte runs become U+FFFD."""
        pieces = self._piece_of(skip_special)
        joined = F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), "")
        return F.make_valid_utf8(F.unhex(joined).cast("string"))

    def ids_of(self, text: str) -> list[int]:
        """Ids of one constant such as a marker, looked up once."""
        if text not in self._constants:
            row = self.vocab.sparkSession.range(1).select(self.encode(F.lit(text))).first()
            self._constants[text] = list(row[0])
        return self._constants[text]


def token_ids(tokens: DataFrame, tokenizer: Tokenizer, column: str = "token") -> DataFrame:
    """Look tokens up by name; unknown names get null."""
    names = tokenizer.vocab.select(F.col("token").alias(column), "token_id")
    return tokens.join(F.broadcast(names), column, "left")
