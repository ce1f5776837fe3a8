"""DataFrame -> DataFrame operators, each parameterised by column names."""
