"""Parameters of the registered queries (one place, shared by the Spark
plans and their SQL oracles)."""

K = 10                    # neighbours per user (the reference's test value)
PARTITIONS = 10           # parts of the approximate method
REPLICATION = 2           # parts per user
LEVELS = (1, 2, 3, 4, 6, 8)  # replication levels of the sweep
TOP_N = 5                 # recommendations per user
NATION = 7                # whose customers similarity_for_users asks for

# Cost model, fixed values of the cost calculator (per second of metered use).
COST_PER_GB_SECOND = 1.6e-7
COST_PER_CPU_SECOND = 1.14e-6
# Resource profile per event type (GB of memory, vCPUs), fixed values.
EVENT_RESOURCES = (
    ("view", 1.0, 0.25),
    ("click", 1.0, 0.5),
    ("purchase", 4.0, 1.0),
    ("signup", 2.0, 1.0),
    ("error", 0.5, 0.125),
)
PRICE_MULTIPLIER = 10_000.0   # purchase price of an asset per unit of list price
OWN_DAILY_COST = 40_000.0     # running cost per day of an owned asset
# Capacity of one bought unit and of the reference machine, fixed values.
UNIT_RAM_GB = 8.0
REFERENCE_RAM_GB = 24.0 * 64.0
REFERENCE_CORES = 2 * 14
UNITS_PER_CORE = 4
