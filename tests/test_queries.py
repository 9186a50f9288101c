"""Every query of the library that has an oracle equals it on whole tables; the others run and give rows."""

import pytest
from compare import compare

from contigframe.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


#: Contigs of the smallest table are so crowded that RNAs mask every CDS, its texts hold few reference passages, and few of its hits lack a product.
LARGER = dict.fromkeys(("rna_masks_cds", "frameshift_fragments", "virulence_landing", "psc_search", "vfdb_search", "intergenic_search"), "sf0.01")


@pytest.fixture(scope="module")
def con(duck):
    return {sf: duck(sf) for sf in ("sf0.001", "sf0.01")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    sf = LARGER.get(name, "sf0.001")
    assert compare(QUERIES[name](spark, f"/root/testdata/{sf}"), con[sf], ORACLES[name]) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, name):
    assert QUERIES[name](spark, f"/root/testdata/{LARGER.get(name, 'sf0.001')}").limit(1).count() == 1


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
