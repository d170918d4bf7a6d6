"""Every operator as a query over whole test tables, with the SQL that checks it."""
