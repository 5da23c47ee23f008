"""DataFrame → DataFrame operators. Each is plain DataFrame/SQL work that
Catalyst plans; Python runs only inside the delivery sender."""
