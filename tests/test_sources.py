"""SRC-1 / SRC-2 / SRC-4: corpus tree, lines, seed list."""

import pytest

from tessera.sources.corpus import read_lines, read_seeds, read_text_tree


def test_text_tree_ordinals(spark, tmp_path):
    files = {"b band/z.txt": "x y\nz", "a band/m.txt": "one", "a band/b.txt": "two\nthree\nfour"}
    for rel, text in files.items():
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    docs = read_text_tree(spark, str(tmp_path))
    got = sorted((r.doc_id, r.source, r.path, r.text) for r in docs.collect())
    assert got == [(0, "a band", "a band/b.txt", "two\nthree\nfour"),
                   (1, "a band", "a band/m.txt", "one"),
                   (2, "b band", "b band/z.txt", "x y\nz")]
    lines = {(r.doc_id, r.line_no): r.line for r in read_lines(docs).collect()}
    assert lines[(0, 2)] == "four" and len(lines) == 6


def test_text_tree_names_and_line_ends(spark, tmp_path):
    p = tmp_path / "Florence + The Machine" / "100% s+1.txt"
    p.parent.mkdir(parents=True)
    p.write_bytes(b"a\r\nb\rc\n")
    docs = read_text_tree(spark, str(tmp_path))
    row = docs.first()
    assert (row.path, row.source) == ("Florence + The Machine/100% s+1.txt", "Florence + The Machine")
    assert [r.line for r in read_lines(docs).orderBy("line_no").collect()] == ["a", "b", "c", ""]


def test_ordinals_carry_no_texts(spark):
    from tessera.sources.corpus import with_ordinal

    df = spark.createDataFrame([(f"p{i % 10}{i}", "text") for i in range(50)], "path string, text string")
    out = with_ordinal(df, "path", "path", "n")
    assert [r.n for r in out.orderBy("path").collect()] == list(range(50))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    checkpointed = [x for x in plan.splitlines() if "_mono" in x and "Project" not in x]
    assert checkpointed and all("text" not in x for x in checkpointed), plan


def test_checkpoint_folder_must_be_named_on_a_cluster(monkeypatch):
    from tessera import session

    class Conf:
        def get(self, *a):
            return None

    class Dir:
        def isEmpty(self):
            return True

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        class _jsc:
            @staticmethod
            def sc():
                class S:
                    @staticmethod
                    def getCheckpointDir():
                        return Dir()
                return S

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_seed_list(spark, tmp_path):
    p = tmp_path / "seeds.txt"
    p.write_text("ABBA\nAC-DC\nAlice in Chains\n")
    assert [r.name for r in read_seeds(spark, str(p)).collect()] == ["ABBA", "AC-DC", "Alice in Chains"]


def test_stored_tables_are_computed_once(spark, tmp_path):
    from tessera.sources.tables import stored

    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "t")
    for _ in range(2):
        assert stored(spark, path, {"k": 5}, compute).count() == 3
    assert len(calls) == 1
    with pytest.raises(ValueError):
        stored(spark, path, {"k": 6}, compute)


def test_text_tree_files_are_opened_once(spark, tmp_path):
    """The result and its ordinals read a written table, not the files."""
    for name in ("a", "b"):
        (tmp_path / "band").mkdir(exist_ok=True)
        (tmp_path / "band" / f"{name}.txt").write_text(name)
    docs = read_text_tree(spark, str(tmp_path))
    assert "text" in docs.columns and not any(f.startswith(f"file://{tmp_path}") or f.startswith(f"file:{tmp_path}") for f in docs.inputFiles())
    assert sorted((r.doc_id, r.path) for r in docs.collect()) == [(0, "band/a.txt"), (1, "band/b.txt")]


def test_a_tree_is_read_by_few_tasks_and_written_without_checksums(spark, monkeypatch, tmp_path):
    import os

    from tessera import session as S
    from tessera.operators import skew
    from tessera.plans.catalog import QUERIES

    made, keep = [], S.scratch_path
    spy = lambda spark, name: (made.append(keep(spark, name)), made[-1])[1]
    monkeypatch.setattr(S, "scratch_path", spy)
    monkeypatch.setattr(skew, "scratch_path", spy)
    docs = spark.range(300).selectExpr("id doc_id", "concat('text\\n', id) text", "'en' lang", "concat('s', id % 3) source", "1L n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["text_tree"](spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == list(range(300)) and len({r.text_md5 for r in got}) == 300
    root, files = (next(p for p in made if f"/{name}-" in p) for name in ("text-tree", "text-files"))
    # 32 files a task by Spark's own settings
    assert len([f for f in os.listdir(files) if f.startswith("part-")]) <= 6
    assert not [f for _, _, names in os.walk(root) for f in names if f.endswith(".crc") and "part" in f]
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(32 << 10)
