"""DataFrame operators: cleaning and slices (clean), star joins (joins), fused
seasonal sums and cohort membership (aggregate), series-scope growth windows and
window ranks (growth), range-split ranks (rank), table-scope windows (table_scope)."""
