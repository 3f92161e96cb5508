"""Small hand-made stars for edge cases (FIXTURES.md section 6)."""

import datetime as dt
from decimal import Decimal as D

from starkpi import schema as S
from starkpi.functions.calendar import calendar
from starkpi.sources.star import Star

FACT_COLS = ["order_id", "line_number", "product_id", "supplier_id", "customer_id", "order_date",
             "ship_date", "quantity", "unit_price", "discount", "sales_amount", "profit"]
FACT_DDL = ("order_id long, line_number int, product_id long, supplier_id long, customer_id long, "
            "order_date date, ship_date date, quantity int, unit_price decimal(18,2), "
            "discount decimal(4,2), sales_amount decimal(18,2), profit decimal(18,2)")


def d(s):
    return dt.date.fromisoformat(s)


def line(order_id, ln, pid, cid, date, qty, price, disc, sales, profit):
    return (order_id, ln, pid, 0, cid, d(date), d(date), qty, D(str(price)), D(str(disc)),
            D(str(sales)), D(str(profit)))


def small_star(spark, lines, products=None, customers=None, start_year=2024, years=1):
    products = products or [(1, "Widget", "Tech", "Gadgets", D("10.00")),
                            (2, "Chair", "Furniture", "Chairs", D("50.00")),
                            (3, "Unsold", "Tech", "Gadgets", D("5.00"))]
    customers = customers or [(1, "Anna Brown", "Consumer", "Germany", "Europe"),
                              (2, "Anna Brown", "Consumer", "France", "Europe"),
                              (3, "Omar Müller", "Corporate", "Japan", "Asia Pacific"),
                              (4, "No Sales", "Consumer", "Japan", "Asia Pacific")]
    return Star(fact=spark.createDataFrame(lines, FACT_DDL),
                product=spark.createDataFrame(products, S.DIM_PRODUCT),
                customer=spark.createDataFrame(customers, S.DIM_CUSTOMER),
                date=calendar(spark, start_year, years))
