import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from annexport.operators.gff3 import (
    HEADER_LINE, clean_dbxref, file_marks, kept_lines, output_lines, split_by_type, split_lines,
)
from annexport.plans.chado import clean_dbxref_files, split_placed, split_placed_files, split_polypeptide_files
from annexport.session import staged
from annexport.sinks.files import placed_lines, write_ordered_lines
from annexport.sources.text import POSITION, numbered, read_gff3, read_lines, read_name_list
from annexport.streaming.gff3 import clean_dbxref_stream, split_polypeptide_stream

NAMES = ["GeneID", "NCBI_GP"]
HEAD = "chr1\tsrc\tgene\t1\t9\t.\t+\t.\t"

ATTRIBUTE_CASES = [
    ("ID=1;Dbxref=GeneID:9,SGD:7;Name=a", "ID=1;Name=a;Dbxref=SGD:7"),
    ("ID=1;Dbxref=GeneID:9;Name=a", "ID=1;Name=a"),
    ("ID=1;Dbxref=SGD:7", "ID=1;Dbxref=SGD:7"),
    ("Dbxref=SGD:7;ID=1", "ID=1;Dbxref=SGD:7"),
    ("ID=1;Dbxref=GeneID:9;", "ID=1;"),
    ("ID=1;Dbxref=SGD:1;Dbxref=GeneID:2", "ID=1;Dbxref=SGD:1Dbxref=GeneID:2"),
    ("ID=1;Note=Dbxref here", "ID=1;Note=Dbxref here"),
    ("ID=1;Dbxref=SGD:GeneID", "ID=1;Dbxref=SGD:GeneID"),
    ("ID=1;Dbxref=", "ID=1;Dbxref="),
    ("Dbxref=GeneID:9", ""),
    ("ID=1;Dbxref=GeneIDX:4,SGD:2", "ID=1;Dbxref=SGD:2"),
    # An empty entry in the list is kept, and so is the tag.
    ("ID=1;Dbxref=GeneID:9,", "ID=1;Dbxref="),
    # A tag that only starts alike has no list to keep.
    ("ID=1;DbxrefX:GeneID", "ID=1"),
    # No attribute but an ending separator.
    ("ID=1;Note=Dbxref;", "ID=1;Note=Dbxref;"),
]

OTHER_LINES = [
    ("## Dbxref=GeneID:1", "## Dbxref=GeneID:1"),
    ("chr1\tDbxref=GeneID:1\tgene", "chr1\tDbxref=GeneID:1\tgene"),
    ("", ""),
    (HEAD + "ID=1;Name=a", HEAD + "ID=1;Name=a"),
    # Fields beyond the ninth stay where they are.
    (HEAD + "ID=1;Dbxref=GeneID:9\textra\t", HEAD + "ID=1\textra\t"),
    # A CR belongs to the line.
    (HEAD + "Dbxref=GeneID:9,SGD:1;ID=1\r", HEAD + "ID=1\r;Dbxref=SGD:1"),
]


def frame(spark, lines, file="f"):
    rows = [(file, 0, i, v) for i, v in enumerate(lines)]
    return spark.createDataFrame(rows, "file string, block long, id long, value string")


def in_order(df):
    return [r.value for r in df.orderBy(*POSITION).collect()]


def test_clean_dbxref_golden(spark):
    cases = [(HEAD + a, HEAD + b) for a, b in ATTRIBUTE_CASES] + OTHER_LINES
    got = in_order(clean_dbxref(frame(spark, [a for a, _ in cases]), NAMES))
    assert got == [b for _, b in cases]


def cleaned_by_rules(line, names):
    """The written rules, one line at a time."""
    cells = line.split("\t")
    if "Dbxref" not in line or len(cells) < 9:
        return line
    attributes = cells[8].split(";")
    references = "".join(a for a in attributes if a.startswith("Dbxref"))
    others = "".join(f"{a};" for a in attributes if not a.startswith("Dbxref"))
    if any(n in references for n in names):
        _, tag, listed = references.partition("Dbxref=")
        left = [r for r in listed.split(",") if not r.startswith(tuple(names))] if listed else []
        references = "Dbxref=" + ",".join(left) if left else ""
    cells[8] = others + references if references else others.removesuffix(";")
    return "\t".join(cells)


@pytest.mark.parametrize("names", [NAMES, ["S.D", "x y"], []])
def test_clean_dbxref_follows_the_rules_on_random_lines(spark, names):
    rng = random.Random(11)
    tokens = ["Dbxref=", "Dbxref", "GeneID:1", "SGD:2", "S.D", "NCBI_GP", ",", ";", "ID=1", "Name=x y", "=", "\t", "\r", " ", "é", "\\", "$1"]
    lines = [
        (HEAD if rng.random() < 0.9 else "") + "".join(rng.choice(tokens) for _ in range(rng.randrange(12)))
        for _ in range(20000)
    ]
    got = in_order(clean_dbxref(frame(spark, lines), names))
    assert [(a, b) for a, b in zip(got, (cleaned_by_rules(v, names) for v in lines)) if a != b] == []


def test_clean_dbxref_without_names_moves_references_to_the_end(spark):
    got = in_order(clean_dbxref(frame(spark, [HEAD + "Dbxref=SGD:7;ID=1"]), []))
    assert got == [HEAD + "ID=1;Dbxref=SGD:7"]


def test_clean_dbxref_is_idempotent_for_one_reference_attribute(spark):
    rng = random.Random(7)
    databases = ["GeneID", "NCBI_GP", "SGD", "EMBL"]
    lines = []
    for i in range(400):
        attributes = [f"ID=g{i}", f"Name=n{i}"]
        refs = ",".join(f"{rng.choice(databases)}:{rng.randrange(99)}" for _ in range(rng.randrange(1, 5)))
        attributes.insert(rng.randrange(3), f"Dbxref={refs}")
        lines.append(HEAD + ";".join(attributes))
    once = clean_dbxref(frame(spark, lines), NAMES)
    assert in_order(clean_dbxref(once, NAMES)) == in_order(once)
    assert not [v for v in in_order(once) if "GeneID" in v or "NCBI_GP" in v]


SPLIT_INPUT = [
    ("##gff-version 3", False),
    (HEAD.replace("gene", "gene") + "ID=1", False),
    (HEAD.replace("gene", "polypeptide") + "ID=2", True),
    ("", False),
    ("short\tline", False),
    ("##FASTA", False),
    (HEAD.replace("gene", "polypeptide") + "ID=3", True),
    ("###", False),
    (HEAD.replace("gene", "polypeptide") + "ID=4", False),
    ("###", False),
    (">seq", False),
    ("ACGT", False),
]


def test_split_golden_and_latch_per_file(spark):
    first = frame(spark, [v for v, _ in SPLIT_INPUT], "a")
    second = frame(spark, [HEAD.replace("gene", "polypeptide") + f"ID={i}" for i in range(20)], "b")
    lines = first.unionByName(second)
    split = split_by_type(lines)
    kept = in_order(kept_lines(split))
    poly = [(r.file, r.value) for r in split_lines(split, file_marks(lines)).orderBy(*POSITION).collect()]
    assert kept == [v for v, is_split in SPLIT_INPUT if not is_split]
    assert [v for f, v in poly if f == "a"] == [HEADER_LINE] + [v for v, s in SPLIT_INPUT if s]
    assert [v for f, v in poly if f == "b"][0] == HEADER_LINE
    assert len([v for f, v in poly if f == "b"]) == 21


@pytest.fixture
def small_splits(spark):
    """Forces many splits per file, with packing that does not follow the file order."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def write_files(folder, sizes, latch_at=None, seed=3):
    rng = random.Random(seed)
    contents = {}
    os.makedirs(folder, exist_ok=True)
    for name, n in sizes.items():
        lines = []
        for i in range(n):
            kind = rng.choice(["gene", "polypeptide", "mRNA"])
            lines.append(HEAD.replace("gene", kind) + f"ID={name}{i};Dbxref=GeneID:{i},SGD:{i}" + "x" * rng.randrange(60))
        if latch_at and name in latch_at:
            lines[latch_at[name]] = "###"
        contents[name] = lines
        with open(f"{folder}/{name}.v2.gff3", "w", newline="") as out:
            out.write("\n".join(lines))  # the last line is not terminated
    return contents


def folder_lines(path):
    lines = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        with open(part, newline="") as handle:
            text = handle.read()
        if text:
            assert text.endswith("\n")
            lines += text[:-1].split("\n")
    return lines


def test_read_lines_order_over_splits(spark, small_splits, tmp_path):
    contents = write_files(str(tmp_path / "in"), {"a": 3001, "b": 50, "c": 900})
    df = read_lines(spark, str(tmp_path / "in"))
    assert df.rdd.getNumPartitions() > 12
    rows = df.orderBy(*POSITION).collect()
    for name, lines in contents.items():
        assert [r.value for r in rows if r.file.endswith(f"/{name}.v2.gff3")] == lines


def test_clean_files_keeps_line_order(spark, small_splits, tmp_path):
    contents = write_files(str(tmp_path / "in"), {"a": 2500})
    out = str(tmp_path / "out")
    clean_dbxref_files(spark, str(tmp_path / "in"), out, NAMES, one_sequence=True)
    expected = in_order(clean_dbxref(frame(spark, contents["a"]), NAMES))
    assert folder_lines(out) == expected
    clean_dbxref_files(spark, str(tmp_path / "in"), out + "2", NAMES, ordered=False)
    assert sorted(folder_lines(out + "2")) == sorted(expected)


def test_clean_files_in_order_without_a_shuffle(spark, small_splits, tmp_path):
    out = str(tmp_path / "out")
    contents = {}
    for folder in ("x", "y"):  # files of one name
        contents |= {(folder, n): v for n, v in write_files(str(tmp_path / folder), {"a b": 900, "c": 70}, seed=ord(folder)).items()}
    clean_dbxref_files(spark, [str(tmp_path / "x"), str(tmp_path / "y")], out, NAMES)
    got = []
    inputs = sorted(glob.glob(f"{out}/input=*"))
    assert len(inputs) == 4
    for folder in inputs:
        starts = sorted(glob.glob(f"{folder}/start=*"))
        assert all(len(glob.glob(f"{s}/part-*")) == 1 for s in starts)
        got.append([v for s in starts for v in folder_lines(s)])
    assert max(len(glob.glob(f"{f}/start=*")) for f in inputs) > 3
    expected = [in_order(clean_dbxref(frame(spark, v), NAMES)) for v in contents.values()]
    assert sorted(got) == sorted(expected)
    lines = numbered(read_lines(spark, str(tmp_path / "x")))
    rows = {(r.file.rsplit("/", 1)[1], r.line_number): r.value for r in lines.collect()}
    assert rows == {(f"{n}.v2.gff3", i + 1): v for (d, n), vs in contents.items() if d == "x" for i, v in enumerate(vs)}


def test_placed_lines_take_no_exchange(spark, tmp_path):
    from tests.test_scale import plan
    write_files(str(tmp_path / "in"), {"a": 50})
    placed = placed_lines(clean_dbxref(read_lines(spark, str(tmp_path / "in")), NAMES))
    assert "Exchange" not in plan(placed)


def test_split_files_over_splits(spark, small_splits, tmp_path):
    contents = write_files(str(tmp_path / "in"), {"a": 3001, "b": 1200}, latch_at={"a": 2100})
    kept, poly = str(tmp_path / "kept"), str(tmp_path / "poly")
    split_polypeptide_files(spark, str(tmp_path / "in"), kept, poly)
    for name, lines in contents.items():
        end = 2100 if name == "a" else len(lines)
        is_split = [i < end and "\tpolypeptide\t" in v for i, v in enumerate(lines)]
        assert folder_lines(f"{kept}/output={name}_no_poly.gff3") == [v for v, s in zip(lines, is_split) if not s]
        assert folder_lines(f"{poly}/output={name}_poly.gff3") == [HEADER_LINE] + [v for v, s in zip(lines, is_split) if s]


def test_gff3_fields_of_short_lines(spark, tmp_path):
    (tmp_path / "x.gff3").write_text("##c\nchr\tsrc\n" + HEAD + "ID=1\n\n", newline="")
    rows = read_gff3(spark, str(tmp_path / "x.gff3")).orderBy(*POSITION).collect()
    assert [r.value for r in rows] == ["##c", "chr\tsrc", HEAD + "ID=1", ""]
    assert (rows[1].seqid, rows[1].source, rows[1].type) == ("chr", "src", None)
    assert (rows[2].type, rows[2].attributes) == ("gene", "ID=1")
    assert rows[3].seqid == ""


def test_name_list(spark, tmp_path):
    (tmp_path / "names.txt").write_text("  FEATURE \n\n--;\nCV;DROP\n\tPUB\t\n")
    assert [r.table_name for r in read_name_list(spark, str(tmp_path / "names.txt")).collect()] == ["FEATURE", "CVDROP", "PUB"]


def test_write_ordered_lines_spreads_one_file(spark, tmp_path):
    df = spark.range(20000).select(
        F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), "id", F.col("id").cast("string").alias("value")
    ).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ordered_lines(df, str(tmp_path / "o"), POSITION)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{tmp_path}/o/part-*")) > 4
    assert folder_lines(str(tmp_path / "o")) == [str(i) for i in range(20000)]


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    first = write_files(folder, {"a": 300})
    clean_dbxref_stream(spark, folder, out, mark, NAMES, files_per_batch=1).awaitTermination()
    second = write_files(folder, {"b": 200}, seed=5)
    clean_dbxref_stream(spark, folder, out, mark, NAMES, files_per_batch=1).awaitTermination()
    expected = in_order(clean_dbxref(frame(spark, first["a"] + second["b"]), NAMES))
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted(expected)


def test_split_names_of_blanks_and_of_clashing_inputs(spark, tmp_path):
    write_files(str(tmp_path / "in"), {"a b+c%20d": 40})
    kept, poly = str(tmp_path / "kept"), str(tmp_path / "poly")
    split_polypeptide_files(spark, str(tmp_path / "in"), kept, poly)
    assert {r.output for r in spark.read.text(kept).select("output").distinct().collect()} == {"a b+c%20d_no_poly.gff3"}
    write_files(str(tmp_path / "x"), {"g": 5})
    write_files(str(tmp_path / "y"), {"g": 5})
    with pytest.raises(ValueError, match="2 inputs would be written to one g_no_poly.gff3"):
        split_polypeptide_files(spark, [str(tmp_path / "x"), str(tmp_path / "y")], kept + "2", poly + "2")
    assert not os.path.exists(kept + "2")


def output_folder_lines(path, name):
    """Lines of an output's folders, in the order of their starts; each has one part file."""
    lines = []
    for start in sorted(glob.glob(f"{path}/output={name}/start=*")):
        assert len(glob.glob(f"{start}/part-*")) == 1
        lines += folder_lines(start)
    return lines


def split_by_rules(lines):
    """Kept and split-off lines, by the written rules."""
    end = next((i for i, v in enumerate(lines) if v.startswith("###")), len(lines))
    off = [i < end and not v.startswith("##") and (v.split("\t") + [""] * 3)[2] == "polypeptide" for i, v in enumerate(lines)]
    return [v for v, s in zip(lines, off) if not s], [HEADER_LINE] + [v for v, s in zip(lines, off) if s]


def test_placed_split_keeps_line_order(spark, small_splits, tmp_path):
    contents = write_files(str(tmp_path / "in"), {"a": 3001, "b": 1200, "c d": 30}, latch_at={"a": 2100})
    (tmp_path / "in" / "empty.gff3").write_text("")
    (tmp_path / "in" / "none.gff3").write_text("##gff-version 3\n")
    out = str(tmp_path / "out")
    split_placed_files(spark, str(tmp_path / "in"), out)
    split_placed_files(spark, str(tmp_path / "in"), out)  # replaces
    for name, lines in [*contents.items(), ("none", ["##gff-version 3"])]:
        kept, poly = split_by_rules(lines)
        assert output_folder_lines(out, f"{name}_no_poly.gff3") == kept
        assert output_folder_lines(out, f"{name}_poly.gff3") == poly
    assert len(glob.glob(f"{out}/output=a_no_poly.gff3/start=*")) > 3
    assert len(glob.glob(f"{out}/output=*")) == 8


def test_placed_split_sorts_and_shuffles_no_line(spark, tmp_path):
    from tests.test_scale import plan
    write_files(str(tmp_path / "in"), {"a": 50})
    lines = read_lines(spark, str(tmp_path / "in"))
    marks = staged(file_marks(lines), "marks")
    found = plan(output_lines(split_by_type(lines, marks=marks), marks))
    exchanges = [x for x in found.splitlines() if "Exchange" in x]
    assert exchanges and all("BroadcastExchange" in x for x in exchanges)  # of the marks
    assert "rangepartitioning" not in found and found.count("FileScan text") == 1


def test_placed_split_of_files_cut_differently(spark, tmp_path):
    """Positions that change from job to job are noticed, and nothing is left of the output."""
    write_files(str(tmp_path / "in"), {"a": 50})
    moving = F.col("block") + F.unix_micros(F.current_timestamp())
    with pytest.raises(RuntimeError, match="cut differently"):
        split_placed(read_lines(spark, str(tmp_path / "in")).withColumn("block", moving), str(tmp_path / "out"))
    assert not os.path.exists(str(tmp_path / "out"))


def test_placed_split_of_clashing_inputs(spark, tmp_path):
    for folder in ("x", "y"):
        write_files(str(tmp_path / folder), {"g": 5})
    with pytest.raises(ValueError, match="2 inputs would be written to one g_no_poly.gff3"):
        split_placed_files(spark, [str(tmp_path / "x"), str(tmp_path / "y")], str(tmp_path / "out"))
    assert not os.path.exists(str(tmp_path / "out"))


def test_split_stream_equals_batch_and_resumes(spark, small_splits, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    contents = write_files(folder, {"a": 900, "b": 40, "c": 300}, latch_at={"a": 700})
    split_polypeptide_stream(spark, folder, out, mark, files_per_batch=2).awaitTermination()
    batches = sorted(glob.glob(f"{out}/batch=*"))
    assert len(batches) == 2
    # A batch that was written but not yet marked as done runs again and takes its own place.
    last = sorted(glob.glob(f"{mark}/commits/*"))[-1]
    os.remove(last)
    os.remove(f"{mark}/commits/.{os.path.basename(last)}.crc")
    contents |= write_files(folder, {"d": 200}, seed=9)
    split_polypeptide_stream(spark, folder, out, mark, files_per_batch=2).awaitTermination()
    assert len(glob.glob(f"{out}/batch=*")) == 3
    split_placed_files(spark, folder, str(tmp_path / "whole"))
    for name, lines in contents.items():
        for output, want in zip((f"{name}_no_poly.gff3", f"{name}_poly.gff3"), split_by_rules(lines)):
            found = [output_folder_lines(b, output) for b in sorted(glob.glob(f"{out}/batch=*")) if os.path.exists(f"{b}/output={output}")]
            assert found == [want] == [output_folder_lines(str(tmp_path / "whole"), output)]
