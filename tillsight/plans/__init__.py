"""Business queries over the retail model (``RetailTables``)."""
