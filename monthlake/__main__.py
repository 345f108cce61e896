from monthlake.cli import main

main()
