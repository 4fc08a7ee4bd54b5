"""Published results of the retail data set of 25 customers: fixed values, half-up rounding."""

# customer, region, orders, total, last order, first order, days since, average, segment
CUSTOMERS = [
    ("ALFKI", "EMEA", 4, "6807.67", "2023-07-03", "2023-01-27", 548, 1701.92, "Churned"),
    ("ANATR", "AMER", 6, "7960.20", "2023-12-19", "2023-04-09", 379, 1326.70, "Churned"),
    ("ANTON", "AMER", 2, "7308.47", "2024-12-09", "2024-10-30", 23, 3654.24, "Active"),
    ("AROUT", "EMEA", 10, "17198.48", "2024-12-07", "2023-02-25", 25, 1719.85, "Active"),
    ("BERGS", "EMEA", 10, "15858.92", "2024-10-22", "2023-03-24", 71, 1585.89, "At Risk"),
    ("BLAUS", "EMEA", 3, "2575.38", "2023-07-20", "2023-01-11", 531, 858.46, "Churned"),
    ("BLONP", "EMEA", 5, "4626.90", "2023-12-06", "2023-04-08", 392, 925.38, "Churned"),
    ("BOLID", "EMEA", 2, "3195.26", "2024-12-14", "2024-11-08", 18, 1597.63, "Active"),
    ("BONAP", "EMEA", 14, "15139.16", "2024-12-24", "2023-01-21", 8, 1081.37, "Active"),
    ("BOTTM", "AMER", 12, "14177.79", "2024-11-24", "2023-02-16", 38, 1181.48, "Active"),
    ("BSBEV", "EMEA", 2, "2108.85", "2023-06-08", "2023-05-28", 573, 1054.43, "Churned"),
    ("CACTU", "AMER", 5, "3096.93", "2023-08-19", "2023-02-11", 501, 619.39, "Churned"),
    ("CENTC", "AMER", 3, "3602.10", "2024-12-27", "2024-10-06", 5, 1200.70, "Active"),
    ("CHOPS", "EMEA", 13, "12889.67", "2024-11-06", "2023-01-30", 56, 991.51, "Active"),
    ("COMMI", "AMER", 9, "8983.97", "2024-12-11", "2023-02-04", 21, 998.22, "Active"),
    ("CONSH", "EMEA", 2, "5313.80", "2023-05-09", "2023-04-12", 603, 2656.90, "Churned"),
    ("DRACD", "EMEA", 6, "8075.06", "2024-03-02", "2023-02-19", 305, 1345.84, "Churned"),
    ("DUMON", "EMEA", 2, "2167.60", "2024-10-15", "2024-10-06", 78, 1083.80, "At Risk"),
    ("EASTC", "EMEA", 9, "12951.61", "2024-12-30", "2023-02-22", 2, 1439.07, "Active"),
    ("FAMIA", "AMER", 8, "7552.44", "2024-11-08", "2023-03-15", 54, 944.06, "Active"),
    ("FOLIG", "EMEA", 3, "2523.05", "2023-07-10", "2023-03-04", 541, 841.02, "Churned"),
    ("FOLKO", "EMEA", 6, "6460.78", "2024-02-24", "2023-02-09", 312, 1076.80, "Churned"),
    ("FRANK", "EMEA", 2, "2734.65", "2024-12-13", "2024-11-17", 19, 1367.33, "Active"),
    ("FRANS", "EMEA", 8, "6642.33", "2024-12-10", "2023-05-21", 22, 830.29, "Active"),
    ("FURIB", "EMEA", 12, "10692.69", "2024-12-23", "2023-01-29", 9, 891.06, "Active"),
]

# month, revenue, orders, customers
MONTHS = [
    ("2023-01", "7287.40", 5, 5), ("2023-02", "14197.35", 11, 10), ("2023-03", "11070.55", 10, 8),
    ("2023-04", "11891.25", 6, 6), ("2023-05", "15671.03", 11, 10), ("2023-06", "8474.30", 7, 7),
    ("2023-07", "7333.15", 9, 8), ("2023-08", "14492.86", 13, 10), ("2023-09", "12737.44", 10, 8),
    ("2023-10", "4622.20", 3, 3), ("2023-11", "2731.90", 4, 4), ("2023-12", "3212.40", 3, 3),
    ("2024-01", "5358.68", 5, 5), ("2024-02", "1732.28", 3, 2), ("2024-03", "3240.04", 4, 4),
    ("2024-04", "4725.18", 3, 1), ("2024-05", "1851.35", 5, 4), ("2024-06", "2875.50", 3, 2),
    ("2024-07", "7484.01", 4, 3), ("2024-08", "9402.39", 8, 5), ("2024-09", "2384.10", 2, 2),
    ("2024-10", "10447.27", 9, 7), ("2024-11", "9564.80", 8, 6), ("2024-12", "17856.33", 12, 10),
]
