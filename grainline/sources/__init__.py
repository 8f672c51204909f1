"""Named tables, business views over them, and partitioned storage."""

from grainline.sources.storage import read_months, refresh_months, stored_rows, write_by_month
from grainline.sources.tables import table
from grainline.sources.views import (
    accounts,
    attendance,
    customers,
    departments,
    dim_customers,
    dim_employees,
    dim_products,
    dim_salespersons,
    employees,
    order_sales,
    orders,
    product_sales,
    region_sales,
    seller_sales,
    sold_orders,
    staff_of_year,
    transfer_requests,
)

__all__ = [
    "accounts",
    "attendance",
    "customers",
    "departments",
    "dim_customers",
    "dim_employees",
    "dim_products",
    "dim_salespersons",
    "employees",
    "order_sales",
    "orders",
    "product_sales",
    "read_months",
    "refresh_months",
    "region_sales",
    "seller_sales",
    "sold_orders",
    "staff_of_year",
    "stored_rows",
    "table",
    "transfer_requests",
    "write_by_month",
]
