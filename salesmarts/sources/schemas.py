"""Declared schemas of the raw tables.

Fixed values: the source systems' own column names and types. Dates stay text until silver.
Ids and order counts are bigint, as they grow with the data.
"""

DATABASE_TABLES = {
    "customers": "CustomerID STRING, CompanyName STRING, ContactName STRING, Country STRING",
    "employees": "EmployeeID BIGINT, FirstName STRING, LastName STRING, Title STRING",
    "shippers": "ShipperID BIGINT, CompanyName STRING",
    "orders": (
        "OrderID BIGINT, CustomerID STRING, EmployeeID BIGINT, OrderDate STRING, ShippedDate STRING, "
        "ShipVia BIGINT, ShipCountry STRING"
    ),
    "orderdetails": "OrderID BIGINT, ProductID BIGINT, UnitPrice DOUBLE, Quantity BIGINT, Discount DOUBLE",
}

CSV_FILES = {
    "categories": "CategoryID BIGINT, CategoryName STRING, Description STRING",
    "suppliers": (
        "SupplierID BIGINT, CompanyName STRING, ContactName STRING, City STRING, Country STRING"
    ),
    "customer_activity_export": (
        "CustomerID STRING, TotalOrders BIGINT, FirstOrderDate STRING, LastOrderDate STRING, "
        "DaysSinceLastOrder BIGINT"
    ),
}

JSON_RECORDS = {
    "products": (
        "ProductID BIGINT, ProductName STRING, CategoryID BIGINT, SupplierID BIGINT, UnitPrice DOUBLE"
    ),
}

# Fields of raw JSON records that are kept as variants: name to (path, type).
JSON_FIELDS = {
    "products": {
        "ProductID": ("$.ProductID", "bigint"),
        "ProductName": ("$.ProductName", "string"),
        "CategoryID": ("$.CategoryID", "bigint"),
        "SupplierID": ("$.SupplierID", "bigint"),
        "UnitPrice": ("$.UnitPrice", "double"),
    },
}
