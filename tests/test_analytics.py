from collections import defaultdict
from datetime import date, datetime, timedelta
from random import Random

from cardmill.functions.calendar import last_days
from cardmill.operators import analytics, filters
from cardmill.plans import marts

SPENDING = "transaction_id int, transaction_date timestamp, client_id int, amount float"


def spending(spark, rows):
    return spark.createDataFrame([(i, d, c, a) for i, (d, c, a) in enumerate(rows)], SPENDING)


def day(month, day_of_month=1, year=2010):
    return datetime(year, month, day_of_month)


def test_last_days_boundary(spark):
    newest = datetime(2010, 6, 30, 15)
    rows = spending(spark, [(newest, 1, 1.0), (datetime(2010, 4, 1), 1, 1.0), (datetime(2010, 3, 31, 23, 59), 1, 1.0)])
    assert analytics.count_last_days(rows).first().n == 2
    assert analytics.count_last_days(rows, anchor=date(2010, 6, 29)).first().n == 3
    assert analytics.count_last_days(rows, days=0).first().n == 1
    assert analytics.count_last_days(rows.limit(0)).first().n == 0
    assert last_days(rows, "transaction_date", 90).count() == 2


def test_year_is_half_open(spark):
    rows = spending(
        spark,
        [
            (datetime(2009, 12, 31, 23, 59, 59), 1, 1.0),
            (datetime(2010, 1, 1), 1, 2.0),
            (datetime(2010, 12, 31, 23, 59, 59), 1, 4.0),
            (datetime(2011, 1, 1), 1, 8.0),
        ],
    )
    assert analytics.top_clients(rows).first().total_spent == 6.0
    assert analytics.top_clients(rows, 2011).first().total_spent == 8.0


def test_ties_go_to_the_smaller_client(spark):
    rows = spending(spark, [(day(1), c, 5.0) for c in (4, 3, 2, 1)] + [(day(2), 9, 1.0)])
    top = analytics.top_clients_per_month(rows).collect()
    assert [(r.month, r.client_id, r["rank"]) for r in top] == [(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 9, 1)]
    assert [r.client_id for r in analytics.top_clients(rows, k=2).collect()] == [1, 2]


def test_client_metrics(spark):
    rows = spending(
        spark,
        [
            (day(5), 1, 10.0), (day(2, 3), 1, 4.0), (day(2, 9), 1, 6.0), (day(7), 1, None),
            (day(8), 2, None), (day(11), 2, None),
            (day(3), 3, -5.0), (day(4), 3, -1.0),
        ],
    )
    got = {r.client_id: r for r in analytics.client_metrics(rows).collect()}
    first = got[1]
    assert (first.year, first.nb_transactions, first.max_spent, first.best_month) == (2010, 4, 10.0, 2)
    assert first.last_transaction_date == day(7)
    assert abs(first.avg_spent - 20 / 3) < 1e-9
    assert (got[2].nb_transactions, got[2].avg_spent, got[2].best_month) == (2, None, 8)
    assert got[3].best_month == 4
    ranked = {r.client_id: r.best_month for r in analytics.best_month(rows).collect()}
    assert ranked == {c: r.best_month for c, r in got.items()}


def test_against_plain_python(spark):
    """Random rows with a client that holds a third of them, ties, missing amounts and three years."""
    random = Random(7)
    rows = [
        (
            datetime(2009, 1, 1) + timedelta(hours=random.randrange(3 * 365 * 24)),
            1 if i % 3 == 0 else random.randrange(2, 60),
            None if random.random() < 0.05 else float(random.randrange(-20, 200)),
        )
        for i in range(3000)
    ]
    frame = spending(spark, rows).repartition(5)
    year = [r for r in rows if r[0].year == 2010]
    months, clients = defaultdict(list), defaultdict(list)
    for when, client, amount in year:
        months[when.month, client].append(amount)
        clients[client].append((when, amount))

    def total(amounts):
        known = [a for a in amounts if a is not None]
        return sum(known) if known else None

    def rank(key_total):  # falling totals, missing ones last, then the key
        key, value = key_total
        return (value is None, -(value or 0), key)

    totals = {k: total(v) for k, v in months.items()}
    got = {(r.month, r.client_id): r.total_spent for r in analytics.monthly_totals(frame).collect()}
    assert got == totals
    top = [(r.month, r["rank"], r.client_id) for r in analytics.top_clients_per_month(frame, k=4).collect()]
    expected = []
    for month in range(1, 13):
        ranked = sorted(((c, t) for (m, c), t in totals.items() if m == month), key=rank)
        expected += [(month, i + 1, c) for i, (c, _) in enumerate(ranked[:4])]
    assert top == expected
    yearly = sorted(((c, total(a for _, a in v)) for c, v in clients.items()), key=rank)[:10]
    assert [(r.client_id, r.total_spent) for r in analytics.top_clients(frame).collect()] == yearly
    for r in analytics.client_metrics(frame).collect():
        mine = clients[r.client_id]
        known = [a for _, a in mine if a is not None]
        best = min(((m, t) for (m, c), t in totals.items() if c == r.client_id), key=rank)[0]
        assert (r.nb_transactions, r.last_transaction_date, r.best_month) == (len(mine), max(w for w, _ in mine), best)
        assert r.max_spent == max(known) and abs(r.avg_spent - sum(known) / len(known)) < 1e-9
    newest = max(when for when, _, _ in rows)
    cutoff = datetime(newest.year, newest.month, newest.day) - timedelta(days=90)
    assert analytics.count_last_days(frame).first().n == sum(when >= cutoff for when, _, _ in rows)


def test_monthly_totals_add_up(spark, sample):
    rows = sample.spending()
    total = analytics.monthly_totals(rows, 1996).groupBy().sum("total_spent").first()[0]
    yearly = analytics.top_clients(rows, 1996, k=10**6).groupBy().sum("total_spent").first()[0]
    assert abs(total - yearly) < 1e-3


def test_column_names_are_parameters(spark):
    rows = spark.createDataFrame([(day(1), 1, 2.0, "x")], "at timestamp, who int, paid float, kind string")
    names = {"client_col": "who", "date_col": "at", "amount_col": "paid"}
    assert analytics.top_clients_per_month(rows, **names).first().total_spent == 2.0
    assert analytics.client_metrics(rows, **names).first().best_month == 1
    assert analytics.average_by_type(rows, "kind", "paid").first().avg_amount == 2.0


def test_marts_count_amounts_and_rows(spark):
    rows = spark.createDataFrame(
        [
            (1, 30, "Male", 5.0, "Yes"),
            (1, 30, "Male", None, "No"),
            (1, 30, "Male", 7.0, None),
            (2, 20, "Female", 1.0, "yes"),
        ],
        "client_id int, current_age int, gender string, amount float, info string",
    )
    kpis = {r.client_id: r for r in marts.client_kpis(rows).collect()}
    assert (kpis[1].total_amount, kpis[1].transaction_count, kpis[1].avg_spent, kpis[1].max_spent) == (2, 3, 6.0, 7.0)
    assert [(r.client_id, r.total_amount) for r in marts.top_consumers(rows).collect()] == [(1, 2), (2, 1)]
    assert marts.transaction_validated(rows).count() == 1
    assert marts.transaction_refused(rows).count() == 1


def test_labels_cover_the_processed_table(sample):
    processed = sample.processed().select("id", "info")
    parts = marts.transaction_validated(processed).count() + marts.transaction_refused(processed).count()
    assert parts == processed.count()


def test_rows_without_a_flag_are_in_neither_view(spark):
    rows = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_fraud boolean")
    filters.create_fraud_views(rows)
    assert [r.id for r in spark.table("fraud_transactions").collect()] == [1]
    assert [r.id for r in spark.table("non_fraud_transactions").collect()] == [2]
