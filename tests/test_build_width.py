"""What the build writes on its way is narrow."""

from decimal import Decimal

from retailstar.plans import normalize


def test_build_moves_few_bytes(spark, tmp_path, monkeypatch):
    """Texts of the sales are not sorted, hashes are not stored, and cells as they came
    are kept with rejects only: what a build writes on its way is narrow."""
    from retailstar.operators import keys, split
    seen = {}

    def noted(make):
        def run(df, name):
            seen.setdefault(name, []).append(df.dtypes)
            return make(df, name)
        return run

    for module in (keys, split):
        monkeypatch.setattr(module, "temporary_table", noted(module.temporary_table))
    rows = [(f"C{i % 3}", f"M{i % 2}", "T", f"L{i % 2}", f"L{i % 2} B{i % 4}", f"P{i % 5}", 2001, "Q1 2001", Decimal(i % 7), i % 4,
             Decimal("0.1")) for i in range(60)]
    flat = spark.createDataFrame(rows, "retailer_country string, order_method_type string, retailer_type string, "
                                 "product_line string, product_type string, product string, year int, quarter string, "
                                 "revenue decimal(18,4), quantity int, gross_margin decimal(6,4)")
    reference = spark.createDataFrame([("C0", 1, "R")], "name string, population long, region string")
    tables = normalize.normalize_entities(flat, reference)
    seen.clear()
    sales = normalize.normalize_sales(flat, tables).orderBy("id").collect()
    widest = [d for v in seen.values() for d in v if "revenue" in dict(d)]
    assert widest and all([c for c, t in d if t == "string"] == ["quarter"] for d in widest)
    # ids follow the flat rows' order
    back = [(r.retailer_country, r.order_method_type, r.retailer_type, r.product_line, r.product_type, r.product, r.revenue, r.quantity)
            for r in normalize.denormalize(tables | {"sales": normalize.normalize_sales(flat, tables)}).orderBy("sales_id").collect()]
    assert back == sorted(back) and len(back) == len(sales) == 60 and [r.id for r in sales] == list(range(1, 61))
    seen.clear()
    assert split.label_split(flat, 0.2).where("part = 'sample'").count() == 12
    assert [c for c, _ in seen["to-split"][0]] == flat.columns
