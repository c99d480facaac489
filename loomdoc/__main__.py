from loomdoc.cli import main

raise SystemExit(main())
