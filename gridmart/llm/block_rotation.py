"""Fill-in-middle transformation by in-place block rotation.

A text is cut into prefix, middle and suffix.  Its UTF-8 bytes are scanned once
for the cuts, the sentinels are inserted into a bytearray, and neighbouring
segments change places by rotation: reverse the left one, reverse the right
one, reverse both as one.  A reversal swaps short runs from both ends, so
besides the bytearray only a run of fixed length is held, however long the text
is.  ``restore`` finds the sentinels in an output, rotates back and takes
them out, which gives the text exactly; it needs the output and its form only.

A sentinel begins with a character that it holds nowhere else, and a text that
holds a sentinel stays plain.  So the first place of a sentinel in an output,
in the order of the form, is the inserted one.

Everything is decided by the id: four unsigned numbers are the first four
groups of eight digits of the hexadecimal sha256 of ``seed:id``.

Cases: null text is empty, and an empty text is plain; a null id counts as the empty
id; repeated rows give the same output each; a text of any length is cut anywhere; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import documents, slices, table

#: Bytes swapped at once by a reversal.
RUN = 1 << 16
OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
RESTORED = OUTPUT + ", restored string"


@dataclass(frozen=True)
class Rule:
    """How texts are cut; the defaults are the production parameters."""

    seed: int = 1
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    #: Of 100 texts so many are transformed, of 100 of these so many begin with the suffix.
    transformed: int = 90
    suffix_first: int = 20

    def __post_init__(self):
        for sentinel in self.sentinels():
            if not sentinel or sentinel[0] in sentinel[1:]:
                raise ValueError(f"the first character of the sentinel {sentinel!r} must not occur in it again")
            if sum(sentinel in other for other in self.sentinels()) > 1:
                raise ValueError(f"the sentinel {sentinel!r} lies in another one")

    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def reverse(view: np.ndarray) -> None:
    """Reverse the bytes of ``view`` where they are."""
    low, high = 0, len(view)
    while high - low > 1:
        step = min(RUN, (high - low) // 2)
        kept = view[low:low + step].copy()
        view[low:low + step] = view[high - step:high][::-1]
        view[high - step:high] = kept[::-1]
        low, high = low + step, high - step


def rotate(view: np.ndarray, start: int, cut: int, stop: int) -> None:
    """Let ``view[start:cut]`` and ``view[cut:stop]`` change places by three reversals."""
    reverse(view[start:cut])
    reverse(view[cut:stop])
    reverse(view[start:stop])


def byte_places(data: bytes | bytearray, *places: int) -> tuple[int, list[int]]:
    """The number of code points of UTF-8 ``data``, and where those numbered ``places`` begin."""
    firsts = np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
    return len(firsts), [int(firsts[p]) if p < len(firsts) else len(data) for p in places]


def draw(rule: Rule, doc_id: int | None) -> list[int]:
    """The four numbers of a document."""
    name = f"{rule.seed}:{'' if doc_id is None else doc_id}"
    digits = hashlib.sha256(name.encode()).hexdigest()
    return [int(digits[k:k + 8], 16) for k in (0, 8, 16, 24)]


def transform(rule: Rule, doc_id: int | None, text: str) -> tuple[int, str, int | None, int | None, str]:
    """(code points, form, prefix and middle length, output) of a text."""
    n = len(text)
    first, second, third, fourth = draw(rule, doc_id)
    if not n or third % 100 >= rule.transformed or any(s in text for s in rule.sentinels()):
        return n, "plain", None, None, text
    a, b = sorted((first % (n + 1), second % (n + 1)))
    data = text.encode()
    _, (cut, end) = byte_places(data, a, b)
    before, after, between = (s.encode() for s in rule.sentinels())
    # <P> prefix <M> middle <S> suffix: the text in its own order.
    made = bytearray(data)
    made[end:end] = after
    made[cut:cut] = between
    made[0:0] = before
    middle_at = len(before) + cut
    suffix_at = middle_at + len(between) + end - cut
    spm = fourth % 100 < rule.suffix_first
    rotate(np.frombuffer(made, dtype=np.uint8), 0 if spm else middle_at, suffix_at, len(made))
    return n, "spm" if spm else "psm", a, b - a, made.decode()


def restore(rule: Rule, form: str, output: str) -> str:
    """The text that ``transform`` was given."""
    if form == "plain":
        return output
    made = bytearray(output.encode())
    before, after, between = (s.encode() for s in rule.sentinels())
    order = (after, before, between) if form == "spm" else (before, after, between)
    places, at = [], 0
    for sentinel in order:
        at = made.index(sentinel, at)
        places.append(at)
        at += len(sentinel)
    view = np.frombuffer(made, dtype=np.uint8)
    if form == "spm":  # the suffix goes behind the rest
        rotate(view, 0, places[1], len(made))
        middle_at, suffix_at = places[2] - places[1], len(made) - places[1]
    else:  # suffix and middle change places
        rotate(view, places[1], places[2], len(made))
        middle_at, suffix_at = places[1], places[1] + len(made) - places[2]
    del view  # a bytearray that is looked at cannot change its length
    del made[suffix_at:suffix_at + len(after)]
    del made[middle_at:middle_at + len(between)]
    del made[0:len(before)]
    return made.decode()


def _columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[t]) for k, (_, t) in enumerate(fields)],
                                      names=[name for name, _ in fields])


def fill_in_middle(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Each document's form and output: doc_id, n, form, prefix_chars, middle_chars, output."""
    def run(batches):
        for part in slices(batches):
            rows = [(doc, *transform(rule, doc, text)) for doc, text in
                    zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True)]
            if rows:
                yield _columns(rows, OUTPUT)

    return documents(docs).mapInArrow(run, OUTPUT)


def restored(outputs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``fill_in_middle`` with ``restored``, the text rebuilt from output and form."""
    names = [c.split()[0] for c in OUTPUT.split(", ")]

    def run(batches):
        for part in slices(batches):
            texts = [restore(rule, form, output) for form, output in
                     zip(part["form"].to_pylist(), part["output"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(part[c] for c in names), pa.array(texts, pa.string())],
                                             names=[*names, "restored"])

    return outputs.select(*names).mapInArrow(run, RESTORED)


def op12_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents transformed and restored, as digests."""
    rows = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


QUERIES = {"op12_block_rotation": op12_block_rotation}

SQL = {"op12_block_rotation": """
with d as (
  select cast(doc_id as bigint) as doc_id, coalesce(text, '') as t,
         sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h
  from documents),
drawn as (
  select doc_id, t, cast(length(t) as bigint) as n,
         cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
         cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4
  from d),
formed as (
  select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from drawn)
select doc_id, n, form,
       case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then t
              when 'psm' then '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
              else '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) end
       ) as output_sha256,
       sha256(t) as restored_sha256
from formed
"""}
