"""Independent SQL for every named query, over the same parquet tables."""

from tallyline.oracles import clickstream, delivery, loyalty, transactions, weekly

ORACLES: dict[str, str] = {
    **loyalty.SQL,
    **delivery.SQL,
    **weekly.SQL,
    **clickstream.SQL,
    **transactions.SQL,
}
