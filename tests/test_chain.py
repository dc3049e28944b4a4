import random

from kinfold.__main__ import main


def test_files_to_results(spark, tmp_path, capsys):
    r = random.Random(1)
    words = "alder birch cedar dogwood elder fir hazel juniper larch maple".split()
    head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    s1, s2, s3, truth = [], [], [], []
    for i in range(120):
        name, address = f"{r.choice(words)} {r.choice(words)} {i} Inc", f"{i} {r.choice(words)} Road, {r.choice(words)}, TX"
        s1.append(f"S1-{i}\t{name}\t{address}\tUS\n")
        ids = []
        if i % 3:
            s2.append(f"S2-{i}\t{name.upper()}\t{address.replace('Road', 'Rd')}\tUS\n")
            ids.append(f"S2-{i}")
        s3.append(f"S3-{i}\tOther {r.choice(words)}\t{i + 500} {r.choice(words)} Lane, {r.choice(words)}, TX\tUS\n")
        truth.append(f"S1-{i}\t{','.join(ids)}\n")
    for name, lines in (("s1", s1), ("s2", s2), ("s3", s3)):
        (tmp_path / f"{name}.tsv").write_text(head + "".join(lines))
    (tmp_path / "truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(truth))
    common = ["--out", str(tmp_path / "out"), *[x for s in ("s1", "s2", "s3") for x in (f"--{s}", str(tmp_path / f"{s}.tsv"))], "--truth", str(tmp_path / "truth.tsv"), "--matches", str(tmp_path / "m.tsv"), "--candidates", str(tmp_path / "c.tsv"), "--iterations", "5", "--check-ids"]
    assert main(["all", *common]) == 0
    assert (tmp_path / "m.tsv").read_text() == (tmp_path / "truth.tsv").read_text()
    assert main(["match", *common, "--by", "model"]) == 0
    assert main(["validate", *common]) == 0
    got = dict(line.split("\t") for line in (tmp_path / "m.tsv").read_text().splitlines()[1:])
    want = dict(line.split("\t") for line in (tmp_path / "truth.tsv").read_text().splitlines()[1:])
    assert sum(got[k] == want[k] for k in want) > 110
    (tmp_path / "odd.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-0\tS2-x\n")
    assert main(["validate", *common, "--matches", str(tmp_path / "odd.tsv")]) == 1
    assert "missing entity" in capsys.readouterr().out
    lines = (tmp_path / "m.tsv").read_text().splitlines(keepends=True)
    for name, text, said in [("h", ["source1_entity_id,matched_entity_ids\n", *lines[1:]], "comma-separated"), ("t", [*lines, "S1-0 no tab\n"], "malformed row"), ("o", [lines[0], lines[2], lines[1], *lines[3:]], "out of order"), ("e", [], "empty file")]:
        (tmp_path / f"{name}.tsv").write_text("".join(text))
        assert main(["validate", *common, "--matches", str(tmp_path / f"{name}.tsv")]) == 1
        assert said in capsys.readouterr().out
    (tmp_path / "p.tsv").write_text("".join([lines[0], "S1-0\tS2-none\n", *lines[2:]]))
    main(["validate", *common, "--matches", str(tmp_path / "p.tsv")])
    said = capsys.readouterr().out
    assert "point 11" in said and "point 12" in said and "point 13" not in said
