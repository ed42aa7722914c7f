import datetime as dt

import duckdb

from medlattice.operators import sequences

D = dt.date


def test_sequences(spark):
    adm = spark.createDataFrame([(10, 1, D(2000, 1, 2)), (11, 1, D(2000, 1, 1)), (12, 1, D(2000, 1, 1)),
                                 (20, 2, D(2000, 1, 1))], "hadm_id long, subject_id long, admit_time date")
    dx = spark.createDataFrame([(10, "E8121"), (10, "250.01"), (10, "250.02"), (11, "401.9"), (12, "999.1"),
                                (20, "401.1")], "hadm_id long, icd9 string")
    cmap = sequences.build_codemap(dx.where("icd9 <> '999.1'"))
    assert {r.code: r.code_idx for r in cmap.collect()} == {"250": 0, "401": 1, "E812": 2}
    long_df = sequences.visit_sequence_long(adm, dx, cmap)
    mort = spark.createDataFrame([(1, 1), (2, 0)], "subject_id long, mortality int")
    nested = {r.subject_id: (r.label, r.seqs)
              for r in sequences.visit_sequences_nested(long_df, sequences.subject_labels(mort)).collect()}
    # visits by time then id: 11 (401), 12 (unknown code -> empty), 10 (250, 250, E812)
    assert nested[1] == (1, [[1], [], [0, 0, 2]])
    assert nested[2] == (0, [[1]])
    assert sequences.num_features(long_df).first()[0] == 3
    hot = {(r.subject_id, r.visit_no, r.code_idx) for r in sequences.multi_hot(long_df).collect()}
    assert (1, 3, 0) in hot and len([h for h in hot if h[:2] == (1, 3)]) == 2
    vecs = {(r.subject_id, r.visit_no): r.multi_hot.toArray().tolist()
            for r in sequences.multi_hot_vectors(long_df, 3).collect()}
    assert vecs[(1, 2)] == [0.0, 0.0, 0.0] and vecs[(1, 3)] == [1.0, 0.0, 1.0]


def test_sequence_sizes_per_stay_counts_match_long_form(spark):
    # stay 10 is listed twice (its codes count twice, it is one visit);
    # stay 12 has only an unknown code; stay 30 has no diagnosis at all
    adm = spark.createDataFrame([(10, 1, "train"), (10, 1, "train"), (11, 1, "train"), (12, 1, "train"),
                                 (20, 2, "test"), (30, 3, "test")],
                                "hadm_id long, subject_id long, split string")
    dx = spark.createDataFrame([(10, "250.01"), (10, "401.9"), (11, "401.9"), (12, "999.1"), (20, "401.1")],
                               "hadm_id long, icd9 string")
    cmap = sequences.build_codemap(dx.where("icd9 <> '999.1'"))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "subject_id long, mortality int")
    labels = sequences.subject_labels(labels)

    def rows(df):
        return sorted(tuple(r) for r in df.select("subject_id", "split", "n_visits", "n_codes", "label").collect())

    by_codes = rows(sequences.sequence_sizes(sequences.visit_code_rows(adm, dx, cmap), labels))
    by_stays = rows(sequences.sequence_sizes(sequences.visit_code_counts(adm, dx, cmap), labels))
    assert by_stays == by_codes
    assert by_stays == [(1, "train", 3, 5, 1), (2, "test", 1, 1, 0), (3, "test", 1, 0, None)]


def test_multi_hot_visits_from_stays_match_long_form(spark):
    adm = spark.createDataFrame([(10, 1, D(2000, 1, 2)), (11, 1, D(2000, 1, 1)), (12, 1, D(2000, 1, 1)),
                                 (20, 2, D(2000, 1, 1))], "hadm_id long, subject_id long, admit_time date")
    dx = spark.createDataFrame([(10, "E8121"), (10, "250.01"), (10, "250.02"), (11, "401.9"), (12, "999.1"),
                                (20, "401.1"), (20, "401.2")], "hadm_id long, icd9 string")
    cmap = sequences.build_codemap(dx.where("icd9 <> '999.1'"))
    via_long = sorted(tuple(r) for r in sequences.multi_hot(sequences.visit_sequence_long(adm, dx, cmap)).collect())
    via_sets = sorted(tuple(r) for r in sequences.multi_hot_visits(adm, dx, cmap).collect())
    assert via_sets == via_long == [(1, 1, 1), (1, 3, 0), (1, 3, 2), (2, 1, 1)]


def test_code_map_is_settled_once_with_its_measured_size(spark):
    from conftest import SMALL
    from medlattice.plans.registry import Fixture
    from medlattice.session import estimated_bytes

    dx = Fixture(spark, SMALL).diagnoses_icd
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    codes = sequences.build_codemap(dx)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before + 1
    assert estimated_bytes(codes) < 64 * 1024  # the measured size of a few dozen codes
    assert sorted(r.code_idx for r in codes.collect()) == list(range(codes.count()))


def test_mortality_scores_every_subject(spark):
    """Each validation and test subject with a stay is scored, also without a known code."""
    import __spark_entry__ as E

    folder = "/root/testdata/sf0.01"
    out = E.queries()["mortality_scores"](spark, folder).collect()
    want = duckdb.sql(f"SELECT DISTINCT o_custkey FROM read_parquet('{folder}/orders.parquet') WHERE o_custkey % 10 > 6").fetchall()
    assert sorted(r.subject_id for r in out) == sorted(x for x, in want) and all(0 < r.mortality < 1 for r in out)
