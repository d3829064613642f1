"""The pipeline's packing takes documents in the order of the mix, whatever files they lie in."""

from __future__ import annotations

import corpus_pipeline
from climate_lake.llm import mixing, packing
from climate_lake.llm.queries import tokenizer
from climate_lake.session import materialise
from tests.llm import test_tokens


def corpus(documents):
    text = lambda k: " ".join(f"word{k * j % 97}" for j in range(20 + k % 50))
    return documents(*[(k, text(k), "en", f"src{(k % 10 > 0) + (k % 10 > 3)}") for k in range(3000)], (None, "no id"), (7, ""))


def scattered(documents):
    """Source by source in seven files: as far from the mix as files can be."""
    frame = corpus(documents)
    return materialise(frame.repartitionByRange(7, "source", "doc_id").sortWithinPartitions("source", "doc_id"), "tested")


def openings(found, rows, **options):
    """The earliest slot in each sequence, in the order of the sequences."""
    slot = {row["doc_id"]: row["mix"]["slot"] for row in mixing.mix(rows, **options).select("doc_id", "mix").collect()}
    first = {}
    for row in (row for row in found if row["doc_id"] != 7):  # two rows have this id
        first[row["sequence_id"]] = min(first.get(row["sequence_id"], 1 << 60), slot[row["doc_id"]])
    return [first[one] for one in sorted(first)]


def test_stage_packs_several_files_in_the_order_of_the_mix(spark, documents, sf_dir):
    rows = scattered(documents)
    found = materialise(corpus_pipeline.packed(spark, rows, sf_dir), "tested").collect()
    test_tokens.check_packing(found, [tuple(row) for row in rows.collect()])
    opened = openings(found, rows)
    assert len(opened) > 20 and opened == sorted(opened)


def test_early_sequences_follow_the_target_weights(documents):
    rows, options = scattered(documents), {"resolution": 10, "block_rows": 16}
    found = packing.pack_mixed(rows, tokenizer(), **options).collect()
    opened = openings(found, rows, **options)
    assert opened == sorted(opened)
    # No source has run out in the first third.
    third = sorted({row["sequence_id"] for row in found})[len(opened) // 3]
    early = [row["doc_id"] for row in found if row["doc_id"] is not None and row["sequence_id"] < third]
    source = {row["doc_id"]: row["source"] for row in rows.collect()}
    for name, share in (("src0", 0.2), ("src1", 0.3), ("src2", 0.5)):
        assert abs(sum(source[one] == name for one in early) / len(early) - share) < 0.06


def test_ranges_of_slots_make_successive_tasks(documents):
    frame = corpus(documents)
    found = packing.pack_mixed(frame, tokenizer(), task_tokens=20_000).collect()
    slot = {row["doc_id"]: row["mix"]["slot"] for row in mixing.mix(frame).select("doc_id", "mix").collect() if row["doc_id"] != 7}
    tasks = {}
    for row in found:
        if row["doc_id"] in slot:
            tasks.setdefault(row["sequence_id"] >> 40, []).append(slot[row["doc_id"]])
    spans = [(min(own), max(own)) for _, own in sorted(tasks.items())]
    assert len(spans) > 2 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_odd_rows(odd_documents, empty_documents):
    frame, rows = odd_documents
    found = packing.pack_mixed(frame, tokenizer()).collect()
    test_tokens.check_packing(found, rows)
    assert "ids" in found[0]
    assert packing.pack_mixed(empty_documents, tokenizer()).count() == 0
